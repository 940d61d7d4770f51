"""License scans: which license notices a text holds.

Words are runs of letters and digits, A-Z as a-z; templates and texts are compared as sets of five-word
shingles. A shingle that no template has cannot count towards a containment, so sets are taken within the
templates' shingles. For templates of up to c shingles a text is covered by windows of 2c positions, every
window overlapping the next by half, so that any run of c positions lies in one of them whole. Each window and
template gets 32 minima; a minimum in common (a band of one row) makes the template a candidate, which is then
verified by the exact share of its shingles in the window.

A window holding three quarters of a template has a Jaccard similarity of at least 0.75 t / (2c + 0.25 t) to
it, t > c / 2 being the template's size: above 0.17, so that 32 bands miss it with a probability below 0.3 %,
and below 0.001 % for one that holds nothing else (0.75). Raise `bands` for more.

A template of fewer than five words is one shingle of its own length, which texts are looked through for as well. Of
a notice of up to SHORT shingles every one with a digit or a license's name (TELLING) must be there, so that another
version or a sister license is another license.

Only built-in functions are used. Defined results: null and empty texts hold nothing; templates without words
are not looked for; a text of fewer than five words is one shingle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvibra.llm.stores import stored

WIDTH = 5
BANDS = 32
CONTAINED = 0.75
SHORT = 64
# words that tell licenses of like wording apart
TELLING = r"[0-9]|^(gnu|affero|lesser|library)$"
# every ASCII character but letters and digits
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _split(rows: DataFrame, text: str) -> DataFrame:
    """The rows with their text as `_words`."""
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), BREAKS)
    return rows.withColumn("_words", words).withColumn(
        "_words", F.when((F.get("_words", F.lit(0)) == "") | (F.element_at("_words", -1) == ""),
                         F.filter("_words", lambda w: w != "")).otherwise(F.col("_words"))).drop(text)


def _shingle(i: F.Column, width: int) -> F.Column:
    # a position past the end is null, which the hash passes over: a short text is hashed whole
    return F.xxhash64(*(F.get(F.col("_words"), i + k) for k in range(width)))


def _hashed(rows: DataFrame, text: str, widths: list[int]) -> DataFrame:
    """Adds `_at`, `_shingle` rows for every shingle of a text, and for every run of as many words as `widths` says."""
    rows = _split(rows, text)
    size = F.size("_words")

    def runs(width: int) -> F.Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(size - width, F.lit(0))), lambda i: _shingle(i, width))
    counts = [F.greatest(size - w, F.lit(0)) + 1 for w in [WIDTH, *widths]]
    rows = rows.select(*[c for c in rows.columns if c != "_words"], *[c.alias(f"_n{k}") for k, c in enumerate(counts[:-1])],
                       F.posexplode(F.when(size > 0, F.concat(*[runs(w) for w in [WIDTH, *widths]]))).alias("_at", "_shingle"))
    # where the runs of one width end, positions begin anew
    ends = [sum((F.col(f"_n{j}") for j in range(k)), F.lit(0)) for k in range(len(widths) + 1)]
    at = F.coalesce(*[F.when(F.col("_at") >= e, F.col("_at") - e) for e in reversed(ends)])
    return rows.withColumn("_at", at).drop(*[f"_n{k}" for k in range(len(widths))])


def _minima(rows: DataFrame, keys: list[str], bands: int) -> DataFrame:
    """`_band` and `_least`: per key and band the least hash of its shingles."""
    least = rows.groupBy(*keys).agg(*[F.min(F.xxhash64("_shingle", F.lit(k))).alias(f"_m{k}") for k in range(bands)])
    return least.select(*keys, F.posexplode(F.array(*[F.col(f"_m{k}") for k in range(bands)])).alias("_band", "_least"))


def scan(docs: DataFrame, templates: Mapping[str, str], id_col: str = "doc_id", text_col: str = "text",
         bands: int = BANDS, contained: float = CONTAINED) -> DataFrame:
    """`id`, `license` and `containment`, the largest share of the template's shingles in one window, for
    every notice found. A row that appears twice is found twice, with the same `row`."""
    spark = docs.sparkSession
    held = _templates(spark, templates)
    known = [r["_shingle"] for r in held.select("_shingle").distinct().collect()]
    widths = sorted(r[0] for r in held.select("_width").distinct().collect() if r[0] < WIDTH)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.col(text_col).alias("_text"))
    hits = _hashed(rows, "_text", widths).filter(F.col("_shingle").isin(known))
    classes = F.broadcast(held.select("_class").distinct())
    windows = (hits.withColumn("_class", F.explode(F.array(*[F.lit(c) for c in sorted(
        r["_class"] for r in classes.collect())]) if known else F.array().cast("array<int>")))
        .withColumn("_part", F.expr("cast(_at as long) div _class"))
        .withColumn("_window", F.explode(F.when(F.col("_part") > 0, F.array(F.col("_part") - 1, "_part"))
                                         .otherwise(F.array("_part"))))
        .select("row", "id", "_class", "_window", "_shingle"))
    keys = ["row", "id", "_class", "_window"]
    windows = stored(windows.distinct())
    signed = _minima(held, ["license", "_class", "_of"], bands)
    candidates = (_minima(windows, keys, bands).join(F.broadcast(signed), ["_class", "_band", "_least"])
                  .select(*keys, "license", "_of").distinct())
    share = (windows.join(candidates, keys)
             .join(F.broadcast(held.select("license", "_shingle", "_must", "_musts")), ["license", "_shingle"])
             .groupBy(*keys, "license", "_of", "_musts")
             .agg((F.count(F.lit(1)) / F.col("_of")).alias("share"), F.count_if("_must").alias("_met"))
             .filter("_met = _musts"))
    return (share.groupBy("row", "id", "license").agg(F.max("share").alias("containment"))
            .filter(F.col("containment") >= contained).select("row", "id", "license", "containment"))


def _templates(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """Distinct shingles of each template, their width and number, its class, the next power of two, and which and how
    many of them must all be there."""
    rows = _split(spark.createDataFrame([(k, v) for k, v in templates.items() if v], "license string, _text string"), "_text")
    rows = rows.filter(F.size("_words") > 0).withColumn("_width", F.least(F.size("_words"), F.lit(WIDTH)))
    each = rows.select("license", "_width", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("_words") - F.col("_width")), lambda i: F.struct(
            _shingle(i, WIDTH).alias("_shingle"),
            F.exists(F.slice("_words", i + 1, F.col("_width")), lambda w: w.rlike(TELLING)).alias("_must")))).alias("_s"))
    each = each.select("license", "_width", "_s.*").distinct()
    sizes = each.groupBy("license").agg(F.count(F.lit(1)).alias("_of"), F.count_if("_must").alias("_musts"))
    power = F.pow(F.lit(2), F.ceil(F.log2("_of"))).cast("int")
    short = F.col("_of") <= SHORT
    found = (each.join(sizes, "license").withColumn("_class", power).withColumn("_must", short & F.col("_must"))
             .withColumn("_musts", F.when(short, F.col("_musts")).otherwise(0))
             .select("license", "_shingle", "_of", "_class", "_width", "_must", "_musts").collect())
    return spark.createDataFrame(found, "license string, _shingle long, _of long, _class int, _width int, _must boolean, "
                                        "_musts long")
