"""Conversation repair against a search over all edits."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from kelvibra.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, kind int, digest string, audit string, cost long, part int"


def cheapest(initials, gone, extra):
    """(cost, audit) by following the grammar, with up to three insertions in a row."""
    after = {"N": {"u": "U", "s": "S"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}

    @functools.lru_cache(None)
    def best(i, state, inserted):
        found = [(0, "")] if i == len(initials) and state in "NA" else []

        def after_edit(cost, letter, rest):
            if rest is not None:
                found.append((rest[0] + cost, letter + rest[1]))
        for letter, to in after[state].items():
            if letter != "s" and inserted < 3:
                after_edit(3, "I", best(i, to, inserted + 1))
            if i < len(initials) and not gone[i]:
                if initials[i] == letter:
                    after_edit(extra[i], "K", best(i + 1, to, 0))
                elif letter != "s":
                    after_edit(3 + extra[i], "R", best(i + 1, to, 0))
        if i < len(initials):
            after_edit(4, "D", best(i + 1, state, 0))
        return min(found, default=None)
    for i in range(len(initials), 0, -50):  # keeps the recursion flat
        for state in after:
            best(i, state, 0)
    return best(0, "N", 0)


def plain(rows):
    """{conv: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)} of (conv, turn, role, text)."""
    convs = {}
    for conv, turn, role, text in rows:
        said = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        said += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, said in convs.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in said:
            kept = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not kept else "duplicate" if (role, text) in seen
                          else "truncated" if kept[-1] not in ".!?" else None)
            seen.add((role, text))
        initials = tuple(role[:1] or " " for _, role, _ in said)
        cost, audit = cheapest(initials, tuple(f in ("blank", "duplicate") for f in faults),
                               tuple(3 * (f == "truncated") for f in faults))
        lines, at, due = [], 0, "user"
        for letter in audit:
            if letter == "I":
                lines.append(f"{due}:")
            else:
                _, role, text = said[at]
                at += 1
                if letter == "D":
                    continue
                lines.append(f"{role if letter == 'K' else due}:{text}")
                if letter == "K" and role[:1] == "s":
                    continue
            due = "assistant" if due == "user" else "user"
        known = [t for t, _, _ in said if t is not None]
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(f) for f in
                     ("blank", "duplicate", "truncated")), sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(df):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = df.collect()
    assert len({r["conv"] for r in rows}) == len(rows)
    return {r["conv"]: tuple(r[c] for c in names) for r in rows}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", "a", 1, 1) for r in rows], SCHEMA)


def hard():
    rng = random.Random(7)
    rows = []
    for conv in range(120):
        for turn in range(rng.randint(1, 9)):
            role = ("system" if turn == 0 and rng.random() < .3 else "user" if turn % 2 == 0 else "assistant") \
                if rng.random() < .8 else rng.choice(["user", "assistant", "system", "tool", "", None, "unknown"])
            text = rng.choice(["Yes.", "No", "", None, " \t\n", "Why?  ", "ok", "é!", "日本語", f"text {turn}.", "a.\x0b"])
            rows.append((conv if conv else None, turn + 3 * (rng.random() < .1) if rng.random() < .95 else None, role, text))
    return rows + [(500, None, "user", "a.")] * 3 + [(501, 5, "user", "x" * 200_000)] + rows[:20]


def test_hard_cases(spark):
    rows = hard()
    assert found(turns.repair(turns.damaged(frame(spark, rows)))) == plain(rows)


@pytest.mark.parametrize("size", [1, 3, 10])
def test_slices_change_nothing(spark, size):
    rows = hard()
    assert found(turns.repair(turns.damaged(frame(spark, rows)), size)) == plain(rows)


def test_whole_small_table(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()]
    assert found(turns.repair(turns.damaged(table))) == plain(rows)


def test_one_long_conversation(spark):
    """Most rows in one conversation, which is dealt over tasks."""
    rng = random.Random(2)
    rows = [(1, i, rng.choice(["user", "assistant"]) if rng.random() < .3 else ("user", "assistant")[i % 2],
             f"t{i % 700}" + rng.choice([".", "", "?"])) for i in range(3000)]
    rows += [(2, i, "user", "x.") for i in range(5)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        got = found(turns.repair(turns.damaged(frame(spark, rows)), 100))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == plain(rows)


def test_slices_join_to_the_whole():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 10)
        rows = ([rng.choice("uuuaaasx ") for _ in range(n)], [rng.random() < .2 for _ in range(n)],
                [3 * (rng.random() < .3) for _ in range(n)])
        want = cheapest(*map(tuple, rows))
        assert turns.alone(turns.Rows(*rows)) == want
        way = turns._Way("c")
        for at in range(0, n, 3):
            part = turns.Rows(*[r[at:at + 3] for r in rows])
            way.add({"ways": [{"way": w, "cost": c, "audit": a} for w, (c, a) in turns.slice_ways(part).items()],
                     "rows": 0, "turns": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0})
        assert (way.row()["cost"], way.row()["audit"]) == want


def test_cells_outside_the_band_stay_empty():
    rows = turns.Rows(["u", "a"] * 100, [False] * 200, [0] * 200)
    table = turns.Alignment(rows, "a")
    assert (table.cost < turns.FAR).sum() < 10 * 200
    assert table.best(True, 0, 2) == (0, "K" * 200)


def test_repaired_turns_hash_to_the_digest(spark):
    rows = turns.damaged(frame(spark, hard()))
    kept = turns.audited(rows)
    want = {r["conv"]: r["repaired_sha256"] for r in turns.digests(rows, kept).collect()}
    lines = {}
    for r in sorted(turns.repaired_turns(rows, kept).collect(), key=lambda r: r["place"]):
        lines.setdefault(r["conv"], []).append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in want} == want


def test_empty(spark):
    assert found(turns.repair(turns.damaged(frame(spark, []).limit(0)))) == {}
