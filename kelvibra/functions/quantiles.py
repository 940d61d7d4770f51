"""Order statistics of a distributed column, exact, without bringing the column to one place."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH = 10_000


def _value_at(values: DataFrame, rank: int, size: int, keep: int) -> float:
    """Value at a 0-based rank. Every pass brackets the rank with a bounded sketch and goes on with
    the open interval between the brackets, which holds at most about 6 / SKETCH of the rows."""
    while size > keep:
        share = rank / (size - 1)
        lo, hi = values.agg(F.percentile_approx(
            "x", [max(0.0, share - 2 / SKETCH), min(1.0, share + 2 / SKETCH)], SKETCH)).first()[0]
        x = F.col("x")
        under, at_lo, between, at_hi = values.agg(
            F.count_if(x < lo), F.count_if(x == lo), F.count_if((x > lo) & (x < hi)),
            F.count_if((x == hi) & (x > lo))).first()
        if under <= rank < under + at_lo:
            return lo
        if rank >= under + at_lo + between:
            if rank < under + at_lo + between + at_hi:
                return hi
            values, rank, size = values.filter(x > hi), rank - under - at_lo - between - at_hi, \
                size - under - at_lo - between - at_hi
        elif rank < under:
            values, size = values.filter(x < lo), under
        else:
            values, rank, size = values.filter((x > lo) & (x < hi)), rank - under - at_lo, between
    # at most `keep` values are left
    return values.agg(F.sort_array(F.collect_list("x"))[rank]).first()[0]


def _next_value(values: DataFrame, low: float, rank: int) -> float:
    """Value at rank + 1, where low is the value at rank."""
    x = F.col("x")
    reach, above = values.agg(F.count_if(x <= low), F.min(F.when(x > low, x))).first()
    return low if reach > rank + 1 else above


def exact_quantiles(df: DataFrame, column: str, probs, method: str = "linear",
                    keep: int = 100_000) -> list[float | None]:
    """Exact quantiles. `linear` interpolates between neighbours, `disc` takes the first value whose
    cumulative share reaches the probability. Nulls and NaN are left out. Runs jobs."""
    values = df.select(F.col(column).cast("double").alias("x")).filter("x is not null and not isnan(x)")
    size = values.count()
    if size == 0:
        return [None for _ in probs]
    out = []
    for p in probs:
        if method == "disc":
            out.append(_value_at(values, max(0, math.ceil(p * size) - 1), size, keep))
            continue
        place = p * (size - 1)
        low = _value_at(values, math.floor(place), size, keep)
        part = place - math.floor(place)
        high = _next_value(values, low, math.floor(place)) if part else low
        out.append(low + part * (high - low))
    return out
