"""URL filtering by rules and by a cascade of Bloom filters.

A cascade tells exactly, for every key of a known universe, whether it is listed. The first filter holds the
listed keys, the second those other keys of the universe that the first lets through by mistake, the third the
listed keys that the second lets through, and so on until none is left; a key is listed if the number of
filters that it passes in a row is odd. All is built and asked with built-in functions, without joins of the
asked rows; what is broadcast is about ten bits per listed key.

Defined results: a null key counts as the empty key; a null url, or one without `://`, has an empty host and
path; keys may repeat; without listed keys nothing is listed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvibra.llm.stores import stored

HASHES = 3
BITS_PER_KEY = 10
MAX_BYTES = 32 << 20


def _places(key: F.Column, level: int, bits: int) -> list[F.Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(k)), F.lit(bits)) for k in range(HASHES)]


def _filter(keys: DataFrame, level: int, count: int) -> tuple[int, bytes]:
    """A Bloom filter of the keys: its bits are set by a bitwise aggregate per 64 of them."""
    bits = max(64, -(-count * BITS_PER_KEY // 64) * 64)
    places = keys.select(F.explode(F.array(*_places(F.col("key"), level, bits))).alias("at"))
    words = places.groupBy(F.expr("at div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits")).collect()
    out = bytearray(bits // 8)
    for word, value in words:
        out[word * 8:word * 8 + 8] = (value % (1 << 64)).to_bytes(8, "little")
    return bits, bytes(out)


def _passes(key: F.Column, level: int, bits: int, data: bytes) -> F.Column:
    def set_at(at: F.Column) -> F.Column:
        byte = F.substring(F.lit(data), F.expr("1") + F.floor(at / 8).cast("int"), F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1
    return reduce(lambda a, b: a & b, [set_at(at) for at in _places(key, level, bits)])


class Cascade:
    """The filters' bits and bytes, level by level."""

    def __init__(self, levels: Sequence[tuple[int, bytes]]):
        self.levels = list(levels)

    @property
    def size(self) -> int:
        return sum(len(data) for _, data in self.levels)

    def contains(self, key: F.Column) -> F.Column:
        """Whether a key of the universe is listed."""
        key, answer = F.coalesce(key, F.lit("")), F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels), 0, -1):
            passes = _passes(key, level, *self.levels[level - 1])
            answer = F.when(~passes, F.lit(level % 2 == 0)).otherwise(answer)
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade | None:
    """A cascade over the column `key` of both tables. Its size is checked before a filter is built: None if
    the filters would be larger than `max_bytes` together."""
    key = F.coalesce(F.col("key"), F.lit("")).alias("key")
    own = stored(listed.select(key).distinct())
    rest = stored(universe.select(key).distinct().join(own, "key", "left_anti"))
    levels, left = [], max_bytes
    while count := own.count():
        if count * BITS_PER_KEY > left * 8:
            return None
        levels.append(_filter(own, len(levels) + 1, count))
        left -= len(levels[-1][1])
        own, rest = stored(rest.filter(_passes(F.col("key"), len(levels), *levels[-1]))), own
    return Cascade(levels)


def flag_listed(rows: DataFrame, listed: DataFrame, key: str, name: str = "listed",
                max_bytes: int = MAX_BYTES) -> DataFrame:
    """Adds whether each row's key is listed. A list too long for a broadcast is joined."""
    cascade = build_cascade(listed, rows.select(F.col(key).alias("key")), max_bytes)
    if cascade is not None:
        return rows.withColumn(name, cascade.contains(F.col(key)))
    keys = listed.select(F.coalesce("key", F.lit("")).alias("_llm_key")).distinct().withColumn("_llm_in", F.lit(True))
    return (rows.join(keys, F.coalesce(F.col(key), F.lit("")) == F.col("_llm_key"), "left")
            .withColumn(name, F.col("_llm_in").isNotNull()).drop("_llm_key", "_llm_in"))


def host(url: F.Column) -> F.Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: F.Column) -> F.Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def under(name: F.Column, domain: str) -> F.Column:
    """Whether a host is a domain or one of its subdomains."""
    return (name == domain) | F.endswith(name, F.lit("." + domain))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], listed: DataFrame, id_col: str = "page_id",
          url_col: str = "url", max_bytes: int = MAX_BYTES) -> DataFrame:
    """`id`, `host`, `path`, `rule` and `verdict` of every url. `rules` has verdict, host and path; the longest
    rule that fits decides. Where none does, hosts in `listed` (column `key`) are blocked."""
    rows = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"),
                        path(F.col(url_col)).alias("path"))
    flagged = flag_listed(rows, listed, "host", "_listed", max_bytes)
    longest = sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0]), reverse=True)

    def first(value) -> F.Column:
        out = F.lit(None).cast("string")
        for rule in reversed(longest):
            fits = under(F.col("host"), rule[1]) & F.startswith(F.col("path"), F.lit(rule[2]))
            out = F.when(fits, F.lit(value(rule))).otherwise(out)
        return out
    method = F.when(F.col("_listed"), "block").otherwise("allow")
    return flagged.select("id", "host", "path", first(lambda r: r[1] + r[2]).alias("rule"),
                          F.coalesce(first(lambda r: r[0]), method).alias("verdict"))
