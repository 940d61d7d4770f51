"""Conversation structure repair by alignment with an alternating grammar.

A well-formed conversation is empty, or an optional system turn and then user and assistant turns in turn, ending with an
assistant. A conversation's rows are aligned, by Wagner-Fischer, with the target strings of that grammar of every length
that can still be cheapest: a row is kept, given another role or deleted, a missing turn is inserted. The last r letters
of all targets are the same, so one table, filled from the end, serves all lengths; its column r is the target of length
r. A cheap repair found first is the incumbent. An alignment that leaves the diagonal by k cells costs at least k
deletions or insertions, so cells farther out than the incumbent's cost allows are not filled (Ukkonen's band). The
cheapest lengths are traced back together, letter by letter, and the least audit in ASCII order stays: deletion, insertion,
keeping, new role (D, I, K, R).

A conversation may have any number of rows. Rows are dealt over tasks by ranges of conversation and order, and cut into
slices of SLICE rows. What the turns before a slice have led to is one of four things: nothing yet, a system turn, a user
or an assistant. A slice is aligned from each of them to each of them, with the letters in between of every length; a
second pass goes through the slices in order, keeps the best audit for each of the four, and writes down what all that
are left have in common. Of two audits of the same rows and cost none is the beginning of the other, so that the lesser
stays the lesser whatever follows. Last, texts meet their audits in order and are hashed one by one, never held together.

Defined results: a null in any column counts as one space, and a null conversation id is a conversation. Rows of a turn
are in order of role and of the digest of their text; equal rows are adjacent. A conversation of which no row is left has
zeros, an empty audit and the hash of nothing. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kelvibra.llm.stores import stored

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
SLICE = 256
NOTHING, SYSTEM, USER, ASSISTANT = "NSUA"
STATES = NOTHING + SYSTEM + USER + ASSISTANT
ROLES = {"u": "user", "a": "assistant"}
FAR = np.int64(1) << 40
SLACK = 4 * (DELETE + INSERT)  # what a turn already given can cost more, at most, than another one
DAMAGES = 20


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults that follow from crc32 of `conv:turn` modulo 20: 0 drops the row, 1 empties its text, 2 takes
    out `.!?`, 3 repeats it, 4 makes it a user's. Columns conv, turn, role, text, dropped."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv), F.lit(":"), space(turn))) % DAMAGES
    said = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(space(text), ".!?", "")).otherwise(space(text))
    out = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                      F.when(kind == 4, F.lit("user")).otherwise(space(role)).alias("role"), said.alias("text"),
                      (kind == 0).alias("dropped"), F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("_c"))
    return out.drop("_c")


WHITE = " \t\n\x0b\f\r"
ORDER = ("turn", "role", "digest")


def facts(rows: DataFrame) -> DataFrame:
    """The rows without their texts: conv, turn, role, digest, dropped, initial, blank, `cut` (does not end with
    `.!?`), `later` (an equal row stands in an earlier turn) and `twin` (the first of equal rows stands in this one)."""
    trimmed = F.rtrim("text", F.lit(WHITE))
    narrow = stored(rows.select(
        "conv", "turn", "role", F.sha2("text", 256).alias("digest"), "dropped",
        F.when(F.col("role") == "", " ").otherwise(F.substring("role", 1, 1)).alias("initial"),
        (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut")))
    key = F.struct("conv", "role", "digest")
    again = narrow.filter("NOT dropped AND NOT blank").groupBy(key.alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("turn").alias("_first"), F.bool_or(F.col("turn").isNull()).alias("_unknown")) \
        .filter("_n > 1")
    marked = narrow.withColumn("_k", key).join(again, "_k", "left")
    unknown = F.col("turn").isNull()  # stands before all others
    return marked.select(
        *narrow.columns, F.coalesce(~unknown & (F.col("_unknown") | (F.col("turn") > F.col("_first"))), F.lit(False)).alias("later"),
        F.coalesce(F.when(F.col("_unknown"), unknown).otherwise(F.col("turn") == F.col("_first")), F.lit(False)).alias("twin"))


@dataclass
class Rows:
    """A slice: each row's initial, whether it has to go, and what keeping it costs in any case."""
    initials: list[str]
    gone: list[bool]
    extra: list[int]

    def __len__(self) -> int:
        return len(self.initials)

    def takes(self, letter: str) -> np.ndarray:
        """The cost of each row as a turn of the user or the assistant."""
        return np.array([FAR if g else (KEEP if i == letter else REROLE) + e
                         for i, g, e in zip(self.initials, self.gone, self.extra)], np.int64)

    def opens(self) -> np.ndarray:
        """The cost of each row as the system's turn."""
        return np.array([KEEP + e if i == "s" and not g else FAR
                         for i, g, e in zip(self.initials, self.gone, self.extra)], np.int64)


def incumbent(rows: Rows) -> int:
    """The cost of a repair that goes through the rows once, from the better of both first letters, and of making its
    first and last letters what they have to be: one insertion in front, two behind."""
    least = DELETE * len(rows)
    for first in "ua":
        cost, due = 0, first
        for initial, gone, extra in zip(rows.initials, rows.gone, rows.extra):
            if gone:
                cost += DELETE
            else:
                cost += (KEEP if initial == due else REROLE) + extra
                due = "a" if due == "u" else "u"
        least = min(least, cost)
    return least + 3 * INSERT


class Alignment:
    """A slice against the alternating strings that end with a letter. `cost[i][r]` is that of the rows from i on
    against the last r letters."""

    def __init__(self, rows: Rows, last: str):
        n = self.n = len(rows)
        self.limit = incumbent(rows)
        self.below, self.above = self.limit // DELETE, self.limit // INSERT
        width = self.width = n + self.above + 1
        other = "a" if last == "u" else "u"
        own = {letter: rows.takes(letter) for letter in "ua"}
        odd = np.arange(width) % 2 == 1  # the r-th letter from the end is the last letter if r is odd
        self.take = np.where(odd[None, :], own[last][:, None], own[other][:, None])
        self.initials, self.gone, self.extra = rows.initials, rows.gone, rows.extra
        self.letters = np.where(odd, last, other).tolist()
        self.open = rows.opens()
        slope = INSERT * np.arange(width)
        cost = np.full((n + 1, width), FAR, np.int64)
        cost[n, :self.above + 1] = slope[:self.above + 1]
        for i in range(n - 1, -1, -1):
            low, high = max(0, n - i - self.below), min(width, n - i + self.above + 1)
            below = cost[i + 1]
            best = below[low:high] + DELETE
            start = max(low, 1)
            best[start - low:] = np.minimum(best[start - low:], below[start - 1:high - 1] + self.take[i, start:high])
            cost[i, low:high] = np.minimum.accumulate(best - slope[low:high]) + slope[low:high]
        self.cost = cost
        # while nothing is said: rows are deleted until the first turn, which may be the system's
        self.silent = cost.copy()
        for i in range(n - 1, -1, -1):
            opened = cost[i + 1] + self.open[i]
            self.silent[i] = np.minimum(np.minimum(cost[i], self.silent[i + 1] + DELETE), opened)

    def best(self, silent: bool, parity: int, least: int) -> tuple[int, str] | None:
        """The cheapest of all lengths of a parity, from `least` on, and its audit."""
        table = self.silent if silent else self.cost
        lengths = np.arange(least + (least - parity) % 2, self.width, 2)
        costs = table[0, lengths]
        cost = int(costs.min(initial=FAR))
        if cost >= FAR:
            return None
        at = {(silent, int(r)) for r in lengths[costs == cost]}
        return cost, self._audit(at, cost)

    def _moves(self, i: int, silent: bool, r: int) -> Iterator[tuple[str, tuple[int, bool, int]]]:
        table = self.silent if silent else self.cost
        cost = table[i, r]
        if i < self.n and table[i + 1, r] + DELETE == cost:
            yield "D", (i + 1, silent, r)
        if r and self.cost[i, r - 1] + INSERT == cost:
            yield "I", (i, False, r - 1)
        if i < self.n and r and self.cost[i + 1, r - 1] + self.take[i, r] == cost:
            yield "K" if self.initials[i] == self.letters[r] else "R", (i + 1, False, r - 1)
        if silent and i < self.n and self.cost[i + 1, r] + self.open[i] == cost:
            yield "K", (i + 1, False, r)

    def _audit(self, at: set[tuple[bool, int]], cost: int) -> str:
        """Goes on along all cheapest ways at once, keeping those whose next letter is least."""
        out, places = [], {(0, silent, r) for silent, r in at}
        while True:
            found = [m for place in places for m in self._moves(*place)]
            if not found:
                return "".join(out)
            letter = min(m[0] for m in found)
            out.append(letter)
            places = {m[1] for m in found if m[0] == letter}


def alone(rows: Rows) -> tuple[int, str]:
    """The cheapest repair of a whole conversation and its audit."""
    none = (DELETE * len(rows), "D" * len(rows))
    found = Alignment(rows, "a").best(True, 0, 2)
    return min(none, found) if found else none


def slice_ways(rows: Rows) -> dict[str, tuple[int, str]]:
    """The cheapest way and its audit for every two of the four states (as a text of two letters)."""
    ways = {s + s: (DELETE * len(rows), "D" * len(rows)) for s in STATES}
    opens = rows.opens()
    if opens.min(initial=FAR) < FAR:
        at = int(np.flatnonzero(opens == opens.min())[-1])  # D before K: the last of the cheapest
        ways[NOTHING + SYSTEM] = (DELETE * (len(rows) - 1) + int(opens[at]), "D" * at + "K" + "D" * (len(rows) - at - 1))
    for end, last in ((USER, "u"), (ASSISTANT, "a")):
        table = Alignment(rows, last)
        odd = 1 if last == "u" else 0  # strings from u: odd ones end with u, even ones with a
        for start, silent, parity, least in ((NOTHING, True, odd, 1), (SYSTEM, False, odd, 1),
                                             (USER, False, 1 - odd, 0), (ASSISTANT, False, odd, 0)):
            found = table.best(silent, parity, least)
            if found:
                ways[start + end] = min(ways.get(start + end, (FAR, "")), found)
    return ways


@lru_cache(1 << 14)
def _short(initials: tuple[str, ...], gone: tuple[bool, ...], extra: tuple[int, ...]) -> tuple[int, str]:
    return alone(Rows(list(initials), list(gone), list(extra)))


WAYS = "array<struct<way: string, cost: bigint, audit: string>>"
SLICES = ("part int, number int, rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          f"first string, last string, low bigint, high bigint, turns bigint, ways {WAYS}")
NO_ID = object()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, dict]]:
    """The rows of sorted batches as dictionaries, each with its conversation."""
    for batch in batches:
        for row in batch.to_pylist():
            yield row["conv"], row


class _Slicer:
    """Cuts sorted rows into slices and counts what they hold."""

    def __init__(self, part: int, size: int):
        self.part, self.size = part, size
        self.conv: object = NO_ID
        self.follows, self.number, self.held, self.mark = False, 0, [], None

    def add(self, conv: object, row: dict) -> Iterator[dict]:
        if conv != self.conv or len(self.held) >= self.size:
            yield from self.cut(conv != self.conv)
            if conv != self.conv:
                self.follows = self.conv is not NO_ID
                self.conv, self.number, self.mark = conv, 0, None
        self.held.append(row)

    def cut(self, ended: bool) -> Iterator[dict]:
        """The slice of the rows held. A conversation that is whole between two others has its one way only."""
        if not self.held:
            return
        kept = [r for r in self.held if not r["dropped"]]
        gone, extra, counts = [], [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for r in kept:
            mark = tuple(r[c] for c in ORDER)
            fault = "blank" if r["blank"] else "duplicate" if r["later"] or (r["twin"] and mark == self.mark) else \
                "truncated" if r["cut"] else None
            self.mark = mark
            gone.append(fault in ("blank", "duplicate"))
            extra.append(CUT_OFF if fault == "truncated" else 0)
            if fault:
                counts[fault] += 1
        rows = Rows([r["initial"] for r in kept], gone, extra)
        if ended and self.follows and self.number == 0:
            ways = {NOTHING + ASSISTANT: _short(tuple(rows.initials), tuple(gone), tuple(extra)) if len(rows) <= 16
                    else alone(rows)}
        else:
            ways = slice_ways(rows) if kept else {s + s: (0, "") for s in STATES}
        turns = [r["turn"] for r in kept if r["turn"] is not None]
        yield {"conv": self.conv, "part": self.part, "number": self.number, "rows": len(kept), **counts,
               "illegal": sum(x + y not in ("su", "ua", "au") for x, y in zip(rows.initials, rows.initials[1:])),
               "first": rows.initials[0] if kept else None, "last": rows.initials[-1] if kept else None,
               "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns)),
               "ways": [{"way": w, "cost": int(c), "audit": a} for w, (c, a) in ways.items()]}
        self.held, self.number = [], self.number + 1


def _batches(found: Iterator[dict], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    out = []
    for row in found:
        out.append(row)
        if len(out) >= size:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _arrow(df: DataFrame, columns: str) -> tuple[str, pa.Schema]:
    """The schema of the conversation's id and some columns, for Spark and for Arrow."""
    ddl = f"conv {df.schema['conv'].dataType.simpleString()}, {columns}"
    return ddl, to_arrow_schema(StructType.fromDDL(ddl))


def slices(marked: DataFrame, size: int = SLICE) -> DataFrame:
    """The slices of facts."""
    ddl, schema = _arrow(marked, SLICES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slicer = _Slicer(TaskContext.get().partitionId(), size)

        def found() -> Iterator[dict]:
            for conv, row in _groups(batches):
                yield from slicer.add(conv, row)
            yield from slicer.cut(False)
        yield from _batches(found(), schema)
    return marked.repartitionByRange("conv", *ORDER).sortWithinPartitions("conv", *ORDER).mapInArrow(work, ddl)


AUDITS = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string")


class _Way:
    """The best audits of a conversation so far, one for each state."""

    def __init__(self, conv: object):
        self.conv = conv
        self.at: dict[str, tuple[int, str]] = {NOTHING: (0, "")}
        self.common: list[str] = []  # what all audits begin with
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.last, self.low, self.high, self.turns = None, None, None, 0

    def add(self, piece: dict) -> None:
        to: dict[str, tuple[int, str]] = {}
        for w in piece["ways"]:
            (start, end), before = w["way"], self.at.get(w["way"][0])
            if before is not None:
                found = before[0] + w["cost"], before[1] + w["audit"]
                to[end] = min(to[end], found) if end in to else found
        least = min(cost for cost, _ in to.values())
        to = {s: found for s, found in to.items() if found[0] <= least + SLACK}
        same = commonprefix([audit for _, audit in to.values()])
        self.common.append(same)
        self.at = {s: (cost, audit[len(same):]) for s, (cost, audit) in to.items()}
        for c in self.counts:
            self.counts[c] += piece[c]
        if piece["rows"]:
            if self.last is not None:
                self.counts["illegal"] += self.last + piece["first"] not in ("su", "ua", "au")
            self.last = piece["last"]
        if piece["turns"]:
            self.turns += piece["turns"] - (self.high == piece["low"])
            self.low, self.high = piece["low"] if self.low is None else self.low, piece["high"]

    def row(self) -> dict:
        cost, audit = min(self.at[s] for s in (NOTHING, ASSISTANT) if s in self.at)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {"conv": self.conv, "gaps": gaps, **self.counts, "cost": cost, "audit": "".join(self.common) + audit}


def audits(pieces: DataFrame) -> DataFrame:
    """A row for each conversation, from its slices in order."""
    ddl, schema = _arrow(pieces, AUDITS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[dict]:
            way = _Way(NO_ID)
            for conv, piece in _groups(batches):
                if conv != way.conv:
                    if way.conv is not NO_ID:
                        yield way.row()
                    way = _Way(conv)
                way.add(piece)
            if way.conv is not NO_ID:
                yield way.row()
        yield from _batches(found(), schema)
    return pieces.repartition("conv").sortWithinPartitions("conv", "part", "number").mapInArrow(work, ddl)


class _Writer:
    """Follows an audit through a conversation's texts and gives the repaired turns one by one."""

    def __init__(self, head: dict):
        self.audit, self.place, self.due = head["audit"], 0, "u"

    def _given(self, letter: str) -> str:
        self.due = "a" if letter == "u" else "u"
        return ROLES[letter]

    def _inserted(self) -> Iterator[tuple[bytes, bytes]]:
        while self.audit[self.place:self.place + 1] == "I":
            self.place += 1
            yield self._given(self.due).encode(), b""

    def turns(self, row: dict | None) -> Iterator[tuple[bytes, bytes]]:
        """The turns up to a row, and the row itself if it stays; those that are left after the last row."""
        yield from self._inserted()
        if row is None:
            return
        letter, self.place = self.audit[self.place], self.place + 1
        if letter == "R":
            yield self._given(self.due).encode(), row["text"]
        elif letter == "K":
            if not row["role"].startswith(b"s"):
                self._given(self.due)
            yield row["role"], row["text"]


def _along(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each audit, then the rows of its conversation in order."""
    heads = found.withColumn("kind", F.lit(0))
    texts = rows.filter("NOT dropped").select(
        "conv", "turn", F.col("role").cast("binary").alias("role"), F.sha2("text", 256).alias("digest"),
        F.col("text").cast("binary").alias("text"), F.lit(1).alias("kind"))
    return heads.unionByName(texts, allowMissingColumns=True).repartition("conv") \
        .sortWithinPartitions("conv", "kind", *ORDER)


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The audits with `repaired_sha256`, of `role:text` lines."""
    ddl, schema = _arrow(found, f"{AUDITS}, repaired_sha256 string")
    names = [f.name for f in StructType.fromDDL(f"conv int, {AUDITS}")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended(head: dict, writer: _Writer, digest, lines: int) -> dict:
            for role, text in writer.turns(None):
                digest.update((b"\n" if lines else b"") + role + b":" + text)
                lines += 1
            return {**{c: head[c] for c in names}, "repaired_sha256": digest.hexdigest()}

        def done() -> Iterator[dict]:
            head, lines = None, 0
            for conv, row in _groups(batches):
                if row["kind"] == 0:
                    if head is not None:
                        yield ended(head, writer, digest, lines)
                    head, writer, digest, lines = row, _Writer(row), hashlib.sha256(), 0
                    continue
                for role, text in writer.turns(row):
                    digest.update((b"\n" if lines else b"") + role + b":")
                    digest.update(text)
                    lines += 1
            if head is not None:
                yield ended(head, writer, digest, lines)
        yield from _batches(done(), schema)
    return _along(rows, found).mapInArrow(work, ddl)


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations themselves: conv, place (from 0), role, text."""
    ddl, schema = _arrow(found, "place bigint, role string, text string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def line(conv: object, place: int, role: bytes, text: bytes) -> dict:
            return {"conv": conv, "place": place, "role": role.decode(), "text": text.decode()}

        def done() -> Iterator[dict]:
            writer, last, place = None, None, 0
            for conv, row in _groups(batches):
                if row["kind"] == 0:
                    for role, text in writer.turns(None) if writer else ():
                        yield line(last, place, role, text)
                        place += 1
                    writer, last, place = _Writer(row), conv, 0
                    continue
                for role, text in writer.turns(row):
                    yield line(conv, place, role, text)
                    place += 1
            for role, text in writer.turns(None) if writer else ():
                yield line(last, place, role, text)
                place += 1
        yield from _batches(done(), schema)
    return _along(rows, found).mapInArrow(work, ddl)


def audited(rows: DataFrame, size: int = SLICE) -> DataFrame:
    """The audits of rows with the columns that `damaged` gives, stored."""
    return stored(audits(stored(slices(facts(rows), size))))


def repair(rows: DataFrame, size: int = SLICE) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    return digests(rows, audited(rows, size))
