"""A local session for tests, checks and the bench."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_folders: list[tempfile.TemporaryDirectory] = []  # removed when the process ends


def local_session(cpus: str | int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("kelvibra")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false"))
    if "spark__checkpoint__dir" not in conf:
        _folders.append(tempfile.TemporaryDirectory(prefix="kelvibra-check-", ignore_cleanup_errors=True))
        conf["spark__checkpoint__dir"] = _folders[-1].name
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
