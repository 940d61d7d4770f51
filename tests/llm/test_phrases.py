"""Phrase collocations against plain counting."""

import collections
import re

import pytest

from kelvibra.llm import phrases

SCHEMA = "doc_id long, text string, lang string, a long, n long, phrase string, score long, freq long, chunk string, size int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 1, "p", 1, 1, "c", 1) for i, (t, lang) in enumerate(rows)], SCHEMA)


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [p for p in (re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", low)) if p]


def plain(rows, least, top, share=100):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    longest = collections.Counter()
    for (lang, p), a in found.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                longest[lang, p[i:i + k]] = max(longest[lang, p[i:i + k]], a)
    out = collections.defaultdict(list)
    for (lang, p), a in found.items():
        if 100 * longest[lang, p] >= share * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -s)
                  for lang, all_ in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(all_)[:top], 1))


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


HARD = [("A b  c\td. a B c", "en"), ("a b c d e f a b c d e f", "en"), (None, "en"), ("", "de"), (" \n .,;", None),
        ("x x x x x x x x", None), ("É b é b c É b", "fr"), ("a b", "fr\nen"), ("q" * 300_000 + " a b", "en"),
        ("a b, a b; a b: a b! a b? a b\x0ba b\x0ca b\ra b", "de"), ("a b c d e f a b c d e f", "en"), ("a b, c", None)]


@pytest.mark.parametrize("every", [1, 2, 5])
def test_hard_cases(spark, every):
    for least in (1, 2):
        assert got(phrases.collocations(frame(spark, HARD), least=least, every=every)) == plain(HARD, least, 2000)


def test_small_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert got(phrases.collocations(docs, least=10, top=100)) == plain(rows, 10, 100)
    assert got(phrases.collocations(docs, least=20, top=50, share=60)) == plain(rows, 20, 50, 60)


def test_a_full_filter_changes_nothing(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = got(phrases.collocations(docs, least=10))
    monkeypatch.setattr(phrases, "MAX_BITS", phrases.SEGMENT)  # nearly all bits are set
    monkeypatch.setattr(phrases, "HELD_WORDS", 1000)
    monkeypatch.setattr(phrases, "GATHERED", 100)
    assert got(phrases.collocations(docs, least=10)) == want


def test_chunks_overlap_and_own_each_word_once():
    text = " ".join(f"w{i % 37}" for i in range(500)).encode()
    found = list(phrases.chunks([b"a b", text, b"", b" .c. ,; d! "], 1 << 30))
    assert [(r, o, c) for r, o, c in found if r != 1] == [(0, 2, b"a b"), (3, 2, b"c\nd")]
    assert [(o, c) for r, o, c in found if r == 1] == [(500, text)]
    found = list(phrases.chunks([b"a b", text], 4))
    assert sum(own for row, own, _ in found if row == 1) == 500
    long = [(own, c.split()) for row, own, c in found if row == 1]
    assert all(len(c) == own + 4 for own, c in long[:-4])
    assert all(c == text.split()[at:at + 4 + own] for at, (own, c) in zip(
        [sum(o for o, _ in long[:i]) for i in range(len(long))], long))
    assert len({c for _, c in map(lambda x: (x[0], tuple(x[1])), long)}) < len(long)  # equal passages, equal chunks


def test_empty_and_none_frequent(spark):
    assert got(phrases.collocations(frame(spark, []).limit(0))) == []
    assert got(phrases.collocations(frame(spark, [("a b c", "en")]))) == []


def test_scores_pass_64_bits(spark):
    rows = spark.range(1).selectExpr("900000000000L AS a", "90000000000000L AS n", "1000000000003L AS l", "999999999989L AS r")
    want = 1000 * 900000000000 * 90000000000000 // (1000000000003 * 999999999989)
    assert rows.selectExpr(f"{phrases.SCORE} AS s").first()["s"] == want
