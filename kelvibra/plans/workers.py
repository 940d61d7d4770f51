"""Making the package known to Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]


def ship(spark: SparkSession) -> None:
    """Sends the package to the workers of a session that was started without it, once per application.
    Spark serves the file to the executors."""
    context = spark.sparkContext
    if getattr(context, "_kelvibra_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="kelvibra-")) / "kelvibra.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    context._kelvibra_shipped = True
