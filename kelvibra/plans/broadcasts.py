"""Broadcasting behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEW_ROWS = 10_000


def broadcast_if_few(df: DataFrame, rows: int = FEW_ROWS) -> DataFrame:
    """Marks a table for broadcast if it has at most `rows` rows, which one short job finds out; a
    longer table stays as it is and Spark picks the join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
