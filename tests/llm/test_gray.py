"""Near duplicates by SimHash in a Gray-order index, against comparing all pairs."""

import random

import numpy as np
import pytest
import xxhash

from kelvibra.llm import gray

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(200_000))
BASE = " ".join(f"base{i}" for i in range(300))
SCHEMA = "doc_id long, text string, fp long, component long, a long, b long, node long, block int, id long"
CASES = [(0, "A b  c"), (1, "a\tB\nc"), (2, None), (3, ""), (4, " \n "), (5, "A b c"), (5, "a b c d"), (None, "A b c"),
         (6, LONG), (7, BASE), (8, BASE.replace("base3 ", "other ")), (9, BASE.upper()), (10, "a b a b a b a b a b"),
         (None, "only here"), (11, "é É   x"), (12, "x" * 3_000_000)]


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(values):
    values = np.array(values, np.uint64)
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= gray.DISTANCE
    labels = np.arange(len(values))
    while True:
        lower = np.array([labels[row].min() for row in close])
        if (lower == labels).all():
            return labels
        labels = lower


def check(rows, cases):
    fps = [plain_fingerprint(t) for _, t in cases]
    labels = plain_components(fps)
    names = {}
    for (i, _), label in zip(cases, labels):
        if i is not None:
            names[label] = min(names.get(label, i), i)
    want = [(i, f"{fp:016x}", names.get(label)) for (i, _), fp, label in zip(cases, fps, labels)]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r["id"], r["fingerprint"], r["component_id"]) for r in rows), key=key) == sorted(want, key=key)


def frame(spark, cases):
    return spark.createDataFrame([(i, t, 1, 1, 1, 1, 1, 1, 1) for i, t in cases], SCHEMA)


def test_hard_cases(spark):
    check(gray.find_near(frame(spark, CASES)).collect(), CASES)


def test_whole_small_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(gray.find_near(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty(spark):
    assert gray.find_near(frame(spark, []).limit(0)).collect() == []


def test_segments_of_a_text_change_nothing(monkeypatch):
    text = (" ".join(f"w{i}" for i in range(3000)) + " " + "y" * 500 + " \n end").encode()
    whole = gray.fingerprint(text)
    assert whole == plain_fingerprint(text.decode())
    monkeypatch.setattr(gray, "SEGMENT", 7)
    assert gray.fingerprint(text) == whole
    assert gray.fingerprint(b"one  two") == plain_fingerprint("one two")


def test_gray_order():
    values = np.array([random.Random(1).getrandbits(64) for _ in range(500)] + [0, 2 ** 64 - 1], np.uint64)
    assert (gray.value_of(gray.rank_of(values)) == values).all()
    steps = gray.value_of(np.arange(1000, dtype=np.uint64))
    assert (np.bitwise_count(steps[1:] ^ steps[:-1]) == 1).all()
    for block in range(len(gray.BLOCKS)):
        ranks = (gray.rank_of(gray.rotated(values, block)) ^ np.uint64(1 << 63)).view(np.int64)
        assert (gray._unturned(ranks, np.full(len(values), block)) == values).all()


def planted(seed, groups=12, per_group=60, alone=400):
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(alone)} | {0, 2 ** 64 - 1}
    for _ in range(groups):
        at = rng.getrandbits(64)
        for _ in range(per_group):
            for b in rng.sample(range(64), rng.randint(0, 5)):
                at ^= 1 << b
            out.add(at)  # each a few bits from the one before: chains
    hub = rng.getrandbits(64)
    out |= {hub ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(400)}
    return sorted(out)


@pytest.mark.parametrize("most", [10, 64, gray.MOST])
def test_links_connect_what_is_close(spark, most):
    """Buckets of all kinds: whole in a task, and cut into many chunks over several tasks."""
    values = planted(most)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = gray.links(spark.createDataFrame([(v,) for v in signed], "fp long"), most)
    at = {v: i for i, v in enumerate(signed)}
    labels = list(range(len(values)))

    def root(i):
        while labels[i] != i:
            i = labels[i]
        return i
    for r in links.collect():
        a, b = root(at[r["a"]]), root(at[r["b"]])
        labels[max(a, b)] = min(a, b)
    assert [root(i) for i in range(len(values))] == plain_components(values).tolist()


def test_a_dense_group_opens_few_pairs(monkeypatch):
    """Forty thousand fingerprints around one: the walk ends once they are connected."""
    rng = random.Random(5)
    values = np.array(sorted({sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(40_000)}), np.uint64)
    values = values[np.argsort(gray.rank_of(values))]
    index, opened = gray.Index(values, np.zeros(1, np.int64)), []
    bounds = index.bounds
    monkeypatch.setattr(index, "bounds", lambda level, a, b: opened.append(len(a)) or bounds(level, a, b))
    index.join(np.zeros(1, np.int64), np.zeros(1, np.int64))
    assert (index.labels == 0).all()
    assert sum(opened) < len(values) ** 2 / 10
