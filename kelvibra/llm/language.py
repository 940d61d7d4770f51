"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams (one to three letters, words padded with
a blank), the most frequent first. A document gets the same list from its whole text, and goes to the
language whose list has it least out of place: every n-gram adds the distance of its two ranks, one that a
profile lacks adds the length of the profile.

Profiles count all n-grams of all documents to learn from. Defined results: a text that is null or has no
letter is `und` with score 0; equal distances go to the language first in order; without any profile every
text is `und`. N-grams of equal count are ranked by their code.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelvibra.llm.words import worker_cache

SIZE = 400
PIECE = 1 << 18
BITS = 21  # a code point
UNKNOWN = "und"


def _alphabet() -> np.ndarray:
    """Each code point's lower-case letter; a blank for all that are not letters."""
    points = range(0x110000)
    return np.fromiter((ord(low) if (c := chr(p)).isalpha() and len(low := c.lower()) == 1 else
                        (p if c.isalpha() else 32) for p in points), np.uint32, 0x110000)


def letters(text: str) -> np.ndarray:
    """Letters in lower case with one blank between words and at either end; empty without letters."""
    table = worker_cache("alphabet", _alphabet)
    blank = np.full(1, 32, np.uint32)
    x = np.concatenate([blank, *(table[np.frombuffer(text[at:at + PIECE].encode("utf-32-le"), np.uint32)]
                                 for at in range(0, len(text), PIECE)), blank])
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    x = x[keep]
    return x if len(x) > 1 else x[:0]


def grams(x: np.ndarray) -> np.ndarray:
    """Codes of all n-grams but those that are blank or have a blank inside."""
    x = x.astype(np.uint64)
    letter = x != 32
    one = x[letter]
    two = (x[:-1] << np.uint64(BITS) | x[1:])
    three = (x[:-2] << np.uint64(2 * BITS) | x[1:-1] << np.uint64(BITS) | x[2:])[letter[1:-1]]
    return np.concatenate([one, two, three])


def counted(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text's letters and their counts, a piece of the text at a time. Pieces share
    the two letters that n-grams over the cut need, and those n-grams are counted in one piece only."""
    if len(x) <= PIECE:
        return np.unique(grams(x), return_counts=True)
    codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for at in range(0, len(x), PIECE):
        own = grams(x[at:at + PIECE + 2])
        over = grams(x[at + PIECE:at + PIECE + 2]) if at + PIECE < len(x) else own[:0]
        c, n = np.unique(own, return_counts=True)
        if len(over):
            n = n - np.bincount(np.searchsorted(c, over), minlength=len(c))
        codes, place = np.unique(np.concatenate([codes, c]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([counts, n]), len(codes)).astype(np.int64)
    return codes[counts > 0], counts[counts > 0]


def ranked(x: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, first first."""
    codes, counts = counted(x)
    if len(codes) > size:
        keep = np.flatnonzero(counts >= np.partition(counts, len(counts) - size)[len(counts) - size])
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))[:size]]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = SIZE) -> dict[str, list[int]]:
    """Each language's profile from all rows with a language. N-grams are counted before they are shuffled;
    a list of `size` codes per language is all that reaches the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        total = 0  # letters of all languages that are held

        def flush(language: str) -> pa.RecordBatch:
            codes, counts = counted(np.concatenate(held.pop(language)))
            return pa.RecordBatch.from_arrays([pa.array([language] * len(codes)), pa.array(codes.astype(np.int64)),
                                               pa.array(counts)], ["lang", "gram", "n"])
        for batch in batches:
            for language, words in zip(batch["lang"].to_pylist(), batch["text"]):
                found = letters(words.as_py())
                held.setdefault(language, []).append(found)
                total += len(found)
                if total > 16 * PIECE:
                    yield from map(flush, list(held))
                    total = 0
        yield from map(flush, list(held))

    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    counts = (rows.mapInArrow(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("rank", rank).filter(F.col("rank") <= size).collect()
    profiles: dict[str, list[int]] = {}
    for row in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Judge:
    """All profiles side by side: for every n-gram of any profile its rank in each."""

    def __init__(self, profiles: dict[str, Sequence[int]], size: int = SIZE):
        self.names, self.size = sorted(profiles), size
        self.codes = np.unique(np.array([g for p in profiles.values() for g in p], np.uint64))
        self.ranks = np.full((len(self.codes), len(self.names)), -1, np.int64)
        for k, name in enumerate(self.names):
            own = np.asarray(profiles[name], np.uint64)
            self.ranks[np.searchsorted(self.codes, own), k] = np.arange(len(own))

    def __call__(self, text: str | None) -> tuple[str, float]:
        x = letters(text or "")
        if not len(x) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(x, self.size)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        theirs = np.where((self.codes[at] == own)[:, None], self.ranks[at], -1)
        away = np.where(theirs >= 0, np.abs(theirs - np.arange(len(own))[:, None]), self.size).sum(axis=0)
        best = int(away.argmin())
        return self.names[best], float(1 - away[best] / (len(own) * self.size))


def predict(profiles: dict[str, list[int]], text: str = "text", size: int = SIZE) -> F.Column:
    """A struct of `lang_pred` and `score`, which is 1 less the share of the largest possible distance."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang_pred string, score double")
    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = Judge(profiles, size)
        for column in columns:
            found = [judge(t.as_py()) for t in column]
            yield pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()),
                                              pa.array([f[1] for f in found], pa.float64())], fields=list(kind))
    return apply(F.col(text))
