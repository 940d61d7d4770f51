"""Scoring models against labels, and comparing them over time."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvibra import settings as S
from kelvibra.functions.expressions import safe_ratio
from kelvibra.operators.scans import scan_range
from kelvibra.plans.lineage import cut
from kelvibra.plans.slices import MAX_ROWS


def _or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(safe_ratio(num, den), F.lit(0.0))


def confusion(df: DataFrame, by: Sequence[str] = (), y: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """D8. tp, fp, tn, fn of 0/1 labels; a class that does not occur counts 0."""
    t, p = F.col(y) == 1, F.col(pred) == 1
    return df.groupBy(*by).agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
        F.count_if(~t & ~p).alias("tn"), F.count_if(t & ~p).alias("fn"))


def _scores(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {"precision": _or_zero(tp, tp + fp), "recall": _or_zero(tp, tp + fn),
            "f1_score": _or_zero(2 * tp, 2 * tp + fp + fn)}


def classification_metrics(df: DataFrame, by: Sequence[str] = (), **columns) -> DataFrame:
    """D9. Precision, recall, F1, accuracy and the two error rates; 0 where undefined."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return confusion(df, by, **columns).select(
        *by, *[v.alias(n) for n, v in _scores(tp, fp, fn).items()],
        _or_zero(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        _or_zero(fp, fp + tn).alias("false_positive_rate"),
        _or_zero(fn, fn + tp).alias("false_negative_rate"))


def class_report(df: DataFrame, by: Sequence[str] = (), **columns) -> DataFrame:
    """D13. Precision, recall, F1 and support of each class, their plain and weighted mean."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    both = {"0": _scores(tn, fn, fp), "1": _scores(tp, fp, fn)}
    support = {"0": tn + fp, "1": tp + fn}
    counts = confusion(df, by, **columns)
    names = ("precision", "recall", "f1_score")

    def line(label: str, values: dict[str, Column], size: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), *[values[n].alias(n) for n in names],
                        size.alias("support"))

    total = support["0"] + support["1"]
    macro = {n: (both["0"][n] + both["1"][n]) / 2 for n in names}
    weighted = {n: _or_zero(both["0"][n] * support["0"] + both["1"][n] * support["1"], total) for n in names}
    lines = F.array(line("0", both["0"], support["0"]), line("1", both["1"], support["1"]),
                    line("macro avg", macro, total), line("weighted avg", weighted, total))
    return counts.select(*by, F.inline(lines))


def auc_roc(df: DataFrame, by: Sequence[str] = (), y: str = "y_true", score: str = "score",
            max_rows: int = MAX_ROWS) -> DataFrame:
    """D10. Area under the ROC curve, equal scores counted half: 0 with a single class, null without
    scores. Rows are first counted per score. Where more than max_rows distinct scores are left, they
    are range-partitioned; sums per slice give each slice its start, and only the scores of one slice
    are ordered together."""
    by = list(by)
    counted = (
        df.filter(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("_s"))
        .agg(F.count_if(F.col(y) == 1).cast("double").alias("_pos"),
             F.count_if(F.col(y) != 1).cast("double").alias("_neg")))
    size = counted.count()
    if size <= max_rows:
        start = F.lit(0.0)
        placed = counted.withColumn("_slice", F.lit(0))
    else:
        start = F.col("_start")
        placed = cut(counted.repartitionByRange(math.ceil(size / max_rows), *by, "_s")
                     .withColumn("_slice", F.spark_partition_id()))
        before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        starts = (placed.groupBy(*by, "_slice").agg(F.sum("_neg").alias("_sum"))
                  .withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0.0))).drop("_sum"))
        placed = placed.join(starts, [*by, "_slice"])
    inside = Window.partitionBy(*by, "_slice").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    under = start + F.coalesce(F.sum("_neg").over(inside), F.lit(0.0))
    wins = F.sum(F.col("_pos") * (F.col("_under") + F.col("_neg") / 2))
    area = placed.withColumn("_under", under).groupBy(*by).agg(
        _or_zero(wins, F.sum("_pos") * F.sum("_neg")).alias("auc_roc"))
    if not by:
        return area
    # models whose scores are all missing keep a row, with a null area
    return _joined(df.select(*by).distinct(), area, by)


def _joined(groups: DataFrame, area: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds the area to every group; a null key is a key like others."""
    area = area.withColumnsRenamed({c: f"_{c}" for c in by})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    return groups.join(area, same, "left").drop(*[f"_{c}" for c in by])


def evaluate(df: DataFrame, by: Sequence[str] = (), score: str | None = "score") -> DataFrame:
    """D9 with D10 beside it."""
    metrics = classification_metrics(df, by)
    if score is None:
        return metrics.withColumn("auc_roc", F.lit(None).cast("double"))
    area = auc_roc(df, by, score=score)
    return _joined(metrics, area, by) if by else metrics.withColumn("auc_roc", area.scalar())


def evaluate_all(predictions: DataFrame, models: Sequence[str], y: str = "y_true") -> DataFrame:
    """J19. One line of metrics per flag column of a labelled table; the area is over the 0/1 flags."""
    long = predictions.select(F.col(y).alias("y_true"), *models).unpivot(
        ["y_true"], list(models), "model_name", "y_pred")
    return evaluate(long.withColumn("score", F.col("y_pred").cast("double")), ["model_name"])


def compare_models(perf: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """F4. Evaluations of the last days, newest first."""
    return (scan_range(perf, f"{days} DAYS", as_of, "evaluation_timestamp")
            .select("model_name", "model_version", "evaluation_timestamp", *S.METRIC_COLUMNS)
            .orderBy(F.desc("evaluation_timestamp"), "model_name", "model_version"))


def best_model(perf: DataFrame, metric: str = "f1_score", as_of=None, days: int = 30) -> DataFrame:
    """F3. The evaluation with the highest value of the metric; ties go to the first by name, version
    and time. Empty if there is none."""
    if metric not in S.METRIC_COLUMNS:
        raise ValueError(f"unknown metric {metric!r}; one of {', '.join(S.METRIC_COLUMNS)}")
    return (scan_range(perf, f"{days} DAYS", as_of, "evaluation_timestamp")
            .filter(F.col(metric).isNotNull())
            .select("model_name", "model_version", "evaluation_timestamp", metric)
            .orderBy(F.desc(metric), "model_name", "model_version", "evaluation_timestamp").limit(1))


def _newest(c: str) -> Column:
    return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("evaluation_timestamp")))


def latest_per_model(perf: DataFrame) -> DataFrame:
    """D11. Per model and column the newest value that is not null, so a line may join evaluations."""
    kept = [c for c in perf.columns if c not in ("model_name", "evaluation_timestamp")]
    return perf.groupBy("model_name").agg(
        *[_newest(c).alias(c) for c in kept], F.max("evaluation_timestamp").alias("evaluation_timestamp"))


def performance_report(perf: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """D12. One line: models, evaluations, the best of three metrics, and advice. No line without
    evaluations."""
    ranged = scan_range(perf, f"{days} DAYS", as_of, "evaluation_timestamp")
    top = ("f1_score", "precision", "recall")

    def best(metric: str) -> Column:
        """Smallest of (-metric, name, version, time): best_model's choice as an aggregate."""
        rank = F.struct((-F.col(metric)).alias("v"), "model_name", "model_version", "evaluation_timestamp")
        return F.min(F.when(F.col(metric).isNotNull(), rank)).alias(f"top_{metric}")

    watched = [c for c, *_ in S.ADVICE]
    by_model = ranged.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("n"), *[_newest(c).alias(f"last_{c}") for c in watched],
        *[best(m) for m in top])
    tests = {"below": lambda c, x: F.max(c) < x, "above": lambda c, x: F.max(c) > x}
    advice = F.concat_ws("|", *[F.when(tests[kind](f"last_{c}", limit), F.lit(text))
                                for c, kind, limit, text in S.ADVICE])
    summary = by_model.agg(
        F.count(F.lit(1)).alias("models"), F.sum("n").alias("evaluations"), advice.alias("advice"),
        *[F.min(f"top_{m}").alias(f"top_{m}") for m in top])
    return summary.filter(F.col("models") > 0).select(
        "models", "evaluations",
        *[F.col(f"top_{m}.model_name").alias(f"best_{m}_model") for m in top],
        *[(-F.col(f"top_{m}.v")).alias(f"best_{m}") for m in top], "advice")
