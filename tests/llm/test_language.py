"""Language profiles and distances against plain counting."""

import collections
import time

from kelvibra.llm import language

SCHEMA = "doc_id long, text string, lang string, gram long, n long"


def words_of(text):
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    return low.split()


def counts_of(text):
    found = collections.Counter()
    for w in words_of(text):
        padded = f" {w} "
        found.update(w)
        found.update(padded[i:i + 2] for i in range(len(padded) - 1))
        found.update(padded[i:i + 3] for i in range(len(padded) - 2) if padded[i + 1] != " ")
    return found


def code(gram):
    out = 0
    for c in gram:
        out = out << language.BITS | ord(c)
    return out



def by_code(found):
    return {code(g): n for g, n in found.items()}


def judged(text, profiles, size=language.SIZE):
    found = by_code(counts_of(text))
    own = sorted(found, key=lambda c: (-found[c], c))[:size]
    if not own:
        return "und", 0.0
    away = {}
    for name, profile in profiles.items():
        rank = {c: i for i, c in enumerate(profile)}
        away[name] = sum(abs(rank[c] - i) if c in rank else size for i, c in enumerate(own))
    best = min(sorted(away), key=away.get)
    return best, 1 - away[best] / (len(own) * size)


def test_profiles_and_distances(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang")
    rows = docs.collect()
    counts = collections.defaultdict(collections.Counter)
    for r in rows:
        counts[r["lang"]].update(counts_of(r["text"]))
    want = {}
    for name, found in counts.items():
        numbers = by_code(found)
        want[name] = sorted(numbers, key=lambda c: (-numbers[c], c))[:language.SIZE]
    profiles = language.learn(docs)
    assert profiles == want
    judge = language.Judge(profiles)
    for text in [r["text"] for r in rows[:60]] + ["", None, "123 .", "é", "Ein Wort", "x" * 5000]:
        name, score = judge(text)
        other, expected = judged(text, want)
        assert name == other and abs(score - expected) < 1e-12


def test_many_short_texts(spark, monkeypatch):
    """Held letters are bounded over all languages, and learning takes time in proportion to the texts."""
    rows = [(i, "ab cd " * 17, f"l{i % 3}", 1, 1) for i in range(40_000)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1).cache()
    docs.count()
    start = time.time()
    profiles = language.learn(docs)
    assert time.time() - start < 30
    monkeypatch.setattr(language, "PIECE", 64)
    assert language.learn(docs.limit(500)) == {k: v for k, v in language.learn(docs.limit(500)).items()}
    assert set(profiles) == {"l0", "l1", "l2"} and len(set(map(tuple, profiles.values()))) == 1


def test_empty_table_and_clashing_names(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert language.learn(none) == {}
    assert none.select(language.predict({}).alias("p")).collect() == []
    rows = spark.createDataFrame([(1, "hallo welt", "de", 5, 6), (2, None, "de", 5, 6), (3, "hello world", None, 1, 1)], SCHEMA)
    assert set(language.learn(rows)) == {"de"}
