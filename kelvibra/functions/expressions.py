"""Column helpers shared by the operators. All stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kelvibra.settings import EPSILON, SEVERITY_CUTS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def known(c: str | Column) -> Column:
    """The value, null where it is NaN: a reading that is not a number counts as missing."""
    return F.when(~F.isnan(col(c)), col(c))


def above(c: str | Column, limit) -> Column:
    """c > limit, false for null and for NaN (Spark orders NaN above every number)."""
    return F.coalesce((col(c) > limit) & ~F.isnan(col(c)), F.lit(False))


def below(c: str | Column, limit) -> Column:
    """c < limit, false for null."""
    return F.coalesce(col(c) < limit, F.lit(False))


def choose(key: str | Column, table: Mapping, default) -> Column:
    """Look a small fixed table up as one CASE; null and unknown keys get the default."""
    cases = reduce(lambda acc, kv: acc.when(col(key) == kv[0], F.lit(kv[1])), table.items(), F)
    return cases.otherwise(F.lit(default))


def severity_ladder(score: str | Column, cuts: Sequence[tuple[str, float]] = SEVERITY_CUTS) -> Column:
    """B14: the first cut that the score exceeds names the severity; NORMAL below all."""
    ladder = reduce(lambda acc, cut: acc.when(above(score, cut[1]), F.lit(cut[0])), cuts, F)
    return ladder.otherwise(F.lit("NORMAL"))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, null where den is 0 or null."""
    return F.try_divide(num, den)


def eps_ratio(num: Column, den: Column) -> Column:
    """num / (den + 1e-8). A denominator of exactly -1e-8 gives null."""
    return F.try_divide(num, den + F.lit(EPSILON))


def interaction_features(df, temperature: str = "temperature", vibration: str = "vibration"):
    """B16: ratio and product of temperature and vibration."""
    t, v = F.col(temperature), F.col(vibration)
    return df.withColumns({
        "temp_vibration_ratio": eps_ratio(t, v),
        "temp_vibration_product": t * v,
    })


def calendar_features(df, timestamp: str = "timestamp"):
    """B17: hour 0-23, weekday with Sunday as 1, day of year."""
    return df.withColumns({
        "hour_of_day": F.hour(timestamp),
        "day_of_week": F.dayofweek(timestamp),
        "day_of_year": F.dayofyear(timestamp),
    })


def iso_text(timestamp: str | Column) -> Column:
    return F.date_format(col(timestamp), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
