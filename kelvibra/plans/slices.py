"""Window features over series of very uneven length.

A series (device) short enough for one task is windowed as usual. A series with more than `max_rows`
rows is cut into slices along its order, and every slice carries the few rows before it that its row
frames can reach. The values are the same as with one window per series; only the work is spread.

Slices are the partitions of a range partitioning by series and order, which Spark balances on a sample
of the rows. They are fixed by a checkpoint, as several branches must see the same cut.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from kelvibra.plans.broadcasts import FEW_ROWS
from kelvibra.plans.lineage import cut

MAX_ROWS = 2_000_000

KEYS = ("device_id",)
ORDER = ("timestamp", "reading_id")
SERIES = "_series"  # the keys as one struct, which joins even where a key is null


@dataclass(frozen=True)
class HotSeries:
    """Series with more than max_rows rows: `_series` and row count `_n`, and how many rows in all."""
    keys: DataFrame
    rows: int


def hot_series(df: DataFrame, keys: Sequence[str], max_rows: int) -> HotSeries | None:
    """One count per series; None if none is hot. At most rows / max_rows series are. Up to FEW_ROWS of
    them become a local table to broadcast; a longer list stays distributed and is joined as Spark
    sees fit. The rows with a null key are a series like others."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > max_rows).select(F.struct(*keys).alias(SERIES), "_n")
    found = hot.take(FEW_ROWS + 1)
    if not found:
        return None
    if len(found) <= FEW_ROWS:
        few = df.sparkSession.createDataFrame(found, hot.schema)
        return HotSeries(F.broadcast(few), sum(r["_n"] for r in found))
    hot = cut(hot)
    return HotSeries(hot, hot.agg(F.sum("_n")).first()[0])


def cold_rows(df: DataFrame, hot: HotSeries, keys: Sequence[str]) -> DataFrame:
    rows = df.withColumn(SERIES, F.struct(*keys))
    return rows.join(hot.keys.select(SERIES), SERIES, "left_anti").drop(SERIES)


def in_slices(df: DataFrame, hot: HotSeries, keys: Sequence[str], order: Sequence[str],
              max_rows: int) -> DataFrame:
    """Rows of the hot series with `_series` and their slice, which ascends along each series."""
    rows = df.withColumn(SERIES, F.struct(*keys)).join(hot.keys.select(SERIES), SERIES, "left_semi")
    slices = math.ceil(hot.rows / max_rows)
    return cut(rows.repartitionByRange(slices, SERIES, *order)
               .withColumn("_slice", F.spark_partition_id()))


def slice_starts(rows: DataFrame) -> DataFrame:
    """Per series and slice: `_start`, the rows of the series before it."""
    before = Window.partitionBy(SERIES).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(SERIES, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    return sizes.select(SERIES, "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))


def lead_in(rows: DataFrame, keys: Sequence[str], order: Sequence[str], lookback: int) -> DataFrame:
    """For each slice the last `lookback` rows of its series before it, which may come from several
    short slices. Works on the ends of slices only: Spark keeps the top rows of a slice before it
    shuffles them."""
    keys = list(keys)
    backwards = Window.partitionBy(*keys, "_slice").orderBy(*[F.desc(c) for c in order])
    ends = rows.withColumn("_back", F.row_number().over(backwards)).filter(F.col("_back") <= lookback)
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    pieces = (
        ends.groupBy(*keys, "_slice").agg(F.max("_back").alias("_held"))
        .withColumn("_total", F.sum("_held").over(by_slice.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_next", F.collect_list(F.struct("_slice", (F.col("_total") - F.col("_held")).alias("_before")))
                    .over(by_slice.rowsBetween(1, lookback)))
        .select(*keys, "_slice", "_total", F.explode("_next").alias("_to")))
    between = F.col("_to._before") - F.col("_total")
    return (ends.join(pieces, [*keys, "_slice"]).filter(between + F.col("_back") <= lookback)
            .withColumn("_slice", F.col("_to._slice")).select(*rows.columns))


def windowed(df: DataFrame, build: Callable[[DataFrame, WindowSpec], DataFrame], lookback: int,
             keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER,
             max_rows: int = MAX_ROWS) -> DataFrame:
    """build(rows, window) adds columns over row frames reaching at most `lookback` rows back. One
    count per series decides whether any series has to be cut."""
    keys, order = list(keys), [c for c in order if c in df.columns]
    plain = Window.partitionBy(*keys).orderBy(*order)
    hot = hot_series(df, keys, max_rows)
    if hot is None:
        return build(df, plain)
    own = in_slices(df, hot, keys, order, max_rows)
    lead = lead_in(own, [SERIES], order, lookback)
    rows = own.withColumn("_lead", F.lit(False)).unionByName(lead.withColumn("_lead", F.lit(True)))
    sliced = build(rows, Window.partitionBy(SERIES, "_slice").orderBy(*order))
    cold = build(cold_rows(df, hot, keys), plain)
    return cold.unionByName(sliced.filter(~F.col("_lead")).drop(SERIES, "_slice", "_lead"))
