"""The text operators against plain Python over a small table of hard cases, and over a small input."""

import collections
import hashlib
import math
import re
import zlib

import pytest
import sentencepiece

import corpus_pipeline
from kelvibra.llm import (decontamination, exact, language, licenses, minhash, pieces, quality, queries, scoring, sharding,
                          urls)
from kelvibra.llm import settings as S
from kelvibra.llm.components import connected

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
BASE = " ".join(f"base{i}" for i in range(60))
ITEM = " ".join(f"item{i}" for i in range(20))
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, file string, row long, n long, "
          "key string, node long, size long, component long, gram long, _text string, _rank long, shard int, first string")
CASES = [
    (0, "A b  c"), (1, "A\tb\nc"), (2, None), (3, ""), (4, " \n "), (5, "A b c"), (5, "A b c"), (None, "A b c"), (6, LONG),
    (7, BASE), (8, BASE.replace("base3 ", "other ")), (9, BASE.upper()), (10, "one two"), (11, "one  TWO"),
    (12, f"x y {ITEM} z"), (13, ITEM.replace("item19", "end")), (14, "Released under the MIT License. Thanks"),
    (15, "日本語 テスト 😀"), (16, "\x00 <unk> ▁ é"), (None, None), (17, "x" * 300_000)]


def frame(spark, cases=CASES):
    return spark.createDataFrame([(i, t, "en", "s", 1, 1, "f", 1, 1, "k", 1, 1, 1, 1, "t", 1, 1, "x") for i, t in cases], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cases"))
    frame(spark).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def small(spark, sf):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def space(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact(docs):
    rows = exact.find_copies(docs).collect()
    assert len(rows) == len(CASES)
    groups = collections.defaultdict(list)
    for i, t in CASES:
        groups[hashlib.sha256(space(t).encode()).hexdigest()].append(i)
    for sha, ids in groups.items():
        own = [r for r in rows if r["text_sha256"] == sha]
        assert sorted(str(r["id"]) for r in own) == sorted(map(str, ids))
        assert {r["group_size"] for r in own} == {len(ids)}
        assert {r["keep_id"] for r in own} == {min((i for i in ids if i is not None), default=None)}
        assert sum(r["kept"] for r in own) == 1
    kept = exact.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_exact_tells_texts_of_one_digest_apart(docs):
    want = {(r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.find_copies(docs).collect()}
    got = {(r["id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.find_copies(docs, key_bytes=0).collect()}
    assert got == want


def test_exact_state_goes_on(spark, tmp_path):
    rows, state, groups = (f"{tmp_path}/{n}" for n in ("rows", "state", "groups"))
    for ids in ([3, 4], [1]):
        spark.createDataFrame([(i, "f", i, bytearray(b"s"), bytearray(b"k")) for i in ids],
                              "id long, file string, row long, sha binary, key binary").write.mode("append").parquet(rows)
        exact.ingest(spark, rows, state, groups)
    found = exact.latest(spark, groups).collect()
    assert [(r["first"]["id"], r["n"]) for r in found] == [(1, 3)]


def brute_near(rows):
    sets = [shingles(t) for _, t in rows]
    head = list(range(len(rows)))

    def top(x):
        while head[x] != x:
            x = head[x]
        return x
    at = collections.defaultdict(list)
    for i, s in enumerate(sets):
        met = collections.Counter(j for x in s for j in at[x])
        for j, n in met.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                head[top(i)] = top(j)
        for x in s:
            at[x].append(i)
    lead = {}
    for i, (number, _) in enumerate(rows):
        if number is not None:
            lead[top(i)] = min(number, lead.get(top(i), number))
    return collections.Counter((n, len(sets[i]), lead.get(top(i))) for i, (n, _) in enumerate(rows))


def test_near(docs, spark, sf, small):
    for source, rows in ((docs, CASES), (spark.read.parquet(f"{sf}/documents.parquet"), small)):
        found = minhash.find_near(source).collect()
        assert collections.Counter((r["id"], r["n_shingles"], r["component_id"]) for r in found) == brute_near(rows)
    assert minhash.deduplicated(docs).columns == docs.columns


def test_near_group_of_many(spark):
    base = [f"v{i}" for i in range(80)]
    rows = [(i, " ".join(base[:i % 70] + [f"n{i}"] + base[i % 70 + 1:]) if i < 120 else " ".join(
        x if (j + i) % 6 else f"m{i}" for j, x in enumerate(base))) for i in range(160)]
    found = minhash.find_near(frame(spark, rows), pivots=2).collect()
    assert collections.Counter((r["id"], r["n_shingles"], r["component_id"]) for r in found) == brute_near(rows)


def test_near_writes_few_tables(spark, monkeypatch):
    """A bucket with a group of near copies and many unlike classes: one round for the group's star, one for all others. Every
    table between costs a job of many tasks, however few rows it has."""
    base = [f"v{i}" for i in range(80)]
    rows = [(i, " ".join(base[:i % 70] + [f"n{i}"] + base[i % 70 + 1:]) if i < 60 else " ".join(
        x if (j + i) % 10 else f"m{i}" for j, x in enumerate(base))) for i in range(100)]
    written, graphs = [], []
    monkeypatch.setattr(minhash, "stored", lambda df, f=minhash.stored: written.append(df.columns) or f(df))
    monkeypatch.setattr(minhash, "connected", lambda df, f=minhash.connected: graphs.append(df.columns) or f(df))
    found = minhash.find_near(frame(spark, rows)).collect()
    assert collections.Counter((r["id"], r["n_shingles"], r["component_id"]) for r in found) == brute_near(rows)
    assert len(written) <= 9 and len(graphs) <= 2


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    assert {(r[0], r[1]) for r in connected(edges).collect()} == {(i, 0) for i in range(41)} | {(100, 100), (101, 100)}


def test_decontamination(spark, docs):
    items = [(1, ITEM), (2, "one two"), (3, None), (4, ""), (5, ITEM), (6, "never seen words at all here")]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["id"], r["item"]): r["similarity"] for r in decontamination.find_items(docs, table).collect()}
    part = 15 / (16 + 16 - 15)
    assert found == {(12, 1): 1.0, (12, 5): 1.0, (13, 1): part, (13, 5): part, (10, 2): 1.0, (11, 2): 1.0}
    blocks = decontamination.find_items(docs, table, item_bytes=10).collect()
    assert {(r["id"], r["item"]): r["similarity"] for r in blocks} == found
    clean = decontamination.clean(docs, table)
    assert clean.columns == docs.columns and clean.count() == len(CASES) - 4
    assert decontamination.clean(docs, table.limit(0)).count() == len(CASES)


@pytest.mark.parametrize("head", [500_000, 2])
def test_scoring(docs, head):
    counts = collections.Counter(w for _, t in CASES for w in [*words(t), b"\n"])
    total, kinds = sum(counts.values()), len(counts)
    got = sorted(scoring.score(docs.select("doc_id", "text"), docs, head=head).collect(), key=lambda r: (str(r[0]), r[1], r[4]))
    want = sorted(((i, len(words(t)) + 1, len(words(t)) + 1, total, sum(
        math.log10((counts[w] + 1) / (total + kinds + 1)) for w in [*words(t), b"\n"])) for i, t in CASES),
        key=lambda r: (str(r[0]), r[1], r[4]))
    assert [tuple(r)[:4] for r in got] == [w[:4] for w in want]
    assert [r[4] for r in got] == pytest.approx([w[4] for w in want])
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    none = scoring.score(docs.select("doc_id", "text"), docs.limit(0)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in none} == {(0, 0, 0.0)}


def test_filter_has_no_level_too_low(spark):
    import numpy as np
    from kelvibra.llm.words import numbers
    grams, counts = numbers(9, 5_000), np.arange(1, 5_001)
    rows = spark.createDataFrame(list(zip(grams.view(np.int64).tolist(), counts.tolist())), "gram long, n long")
    built = scoring.build_filter(rows, 4)
    assert (built.levels(grams) >= scoring.levels_of(counts)).all()
    assert (built.levels(numbers(8, 5_000)) > 0).mean() < 0.1


def test_filter_grows_with_its_entries(spark):
    rows = spark.range(1 << 17).selectExpr("xxhash64(id) AS gram", "1L AS n")
    assert scoring.needed(rows) == 8 and scoring.needed(rows.union(rows.limit(1))) == 16
    assert scoring.needed(rows.withColumn("n", rows["n"] * 8)) == 32


def test_scoring_is_the_same_when_the_filter_is_not_sent(spark, sf, docs):
    for rows in (docs.select("doc_id", "text"), spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")):
        trained = rows.filter("doc_id % 7 != 2")
        sent, kept = (sorted(map(tuple, scoring.score(rows, trained, max_bits=m, head=50, lot=2).collect()), key=str) for m in (1 << 40, 0))
        assert sent == kept


def test_sharding(spark):
    rows = [(i if i % 9 else None, None if i % 11 == 0 else f"text {i % 50}", "en", (None, "a", "b", "a", "a")[i % 5], 1)
            for i in range(1_003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard int")
    found = sharding.interleave(docs, bucket_rows=100).collect()
    sizes = collections.Counter(r["shard"] for r in found)
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for k in sizes:
        assert sorted(r["slot"] for r in found if r["shard"] == k) == list(range(sizes[k]))
    want = collections.Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert collections.Counter((r["id"], r["size"], r["text_crc32"]) for r in found) == want
    assert sharding.interleave(docs.limit(0)).count() == 0


def test_shards_have_the_mixture(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "abbbbc"[i % 6]) for i in range(2_400)], "doc_id long, text string, source string")
    found = sharding.interleave(docs, bucket_rows=300).join(docs.withColumnRenamed("doc_id", "id"), "id")
    mixed = found.groupBy("shard", "source").count().collect()
    assert all(abs(r["count"] - {"a": 50, "b": 200, "c": 50}[r["source"]]) <= 1 for r in mixed)


def test_pieces(docs, small):
    library = sentencepiece.SentencePieceProcessor(model_file=S.PIECE_MODEL)
    coder = pieces.Coder(pieces.Model(S.PIECE_MODEL))
    for text in [t or "" for _, t in CASES[:-1]] + [t for _, t in small[:80]] + ["  two  blanks ", "<0x41>", " a", "a "]:
        ids = library.encode(text)
        joined, count, back, ends = coder(text)
        assert (joined, count, back) == (",".join(map(str, ids)), len(ids), library.decode(ids))
        numbers, spans = coder.model.encode(text)
        assert numbers == ids and [e for _, e in spans] == ends.tolist()
        assert not text or ends[-1] == len(text.encode())
    rows = docs.filter("doc_id < 6").select("text", pieces.encoded(S.PIECE_MODEL).alias("e")) \
        .select("text", "e.ids", pieces.decoded(S.PIECE_MODEL, "e.ids").alias("back")).collect()
    assert all(r["back"] == (r["text"] or "") for r in rows)


def test_normaliser_follows_the_character_map():
    for rule in ("nmt_nfkc", "nfkc_cf"):
        library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        own = pieces.Normaliser(dict(pieces.fields(library.serialized_model_proto()))[3])
        for text in ("ﬁ ①Ａ  ｶﾞ ", "", "  x", "é", "Ⅷ㌔"):
            data, places = own(text.encode())
            assert data.decode() == library.normalize(text)
            assert places == sorted(places) and len(places) == len(data) + 1


def test_licenses(docs, spark):
    found = {(r["id"], r["license"]) for r in licenses.scan(docs, S.LICENSES).collect()}
    assert found == {(14, "MIT")}
    notice = S.LICENSES["Apache-2.0 notice"]
    texts = [(1, f"{LONG} {notice} {LONG}"), (2, notice.replace("License", "Licence")), (2, None), (3, notice.upper())]
    found = licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), S.LICENSES).collect()
    assert {(r["id"], r["license"]) for r in found} == {
        (1, "Apache-2.0"), (3, "Apache-2.0"), (1, "Apache-2.0 notice"), (3, "Apache-2.0 notice")}
    assert licenses.scan(docs, {"none": ""}).count() == 0


def test_licenses_of_few_words_and_other_versions(spark):
    two = "Our work is licensed under the GNU General Public License, version 2."
    texts = [(1, f"{BASE} All rights reserved. {BASE}"), (2, "ALL RIGHTS RESERVED"), (3, "all rights are reserved"),
             (4, f"{BASE} all rights reserved"), (5, f"{BASE} This work is licensed under the GNU General Public License, version 2."),
             (6, f"This work is licensed under the GNU General Public License, version 3. {BASE}"), (7, two), (8, "two words"),
             (9, f"{BASE} {S.LICENSES['ISC']}"), (10, "one two three two words"),
             (11, S.LICENSES["LGPL notice"])]
    templates = S.LICENSES | {"two": "two words"}
    found = licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), templates).collect()
    assert {(r["id"], r["license"]) for r in found} == {
        (1, "All rights reserved"), (2, "All rights reserved"), (4, "All rights reserved"), (5, "GPL-2.0"), (6, "GPL-3.0"),
        (7, "GPL-2.0"), (8, "two"), (9, "ISC"), (10, "two"), (11, "LGPL notice")}


def test_urls(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(4_000)] + [(None,), ("k1",)], "key string")
    listed = keys.filter("cast(substr(key, 2) as int) % 3 = 0")
    cascade = urls.build_cascade(listed, keys)
    assert len(cascade.levels) > 1
    assert keys.filter(cascade.contains(keys["key"])).distinct().count() == 1_334
    assert urls.build_cascade(listed, keys, max_bytes=100) is None
    pages = [(1, "http://A.org"), (2, "x://b.example.org/es/1?q"), (3, None), (4, "no url"), (5, "://ads.com#f"), (6, "h://ads.com/fr/")]
    table = spark.createDataFrame(pages, "page_id long, url string")
    for size in (urls.MAX_BYTES, 0):
        found = urls.judge(table, S.URL_RULES, spark.createDataFrame([("ads.com",)], "key string"), max_bytes=size).collect()
        assert sorted(tuple(r) for r in found) == [
            (1, "a.org", "", None, "allow"), (2, "b.example.org", "/es/1", "example.org/es/", "block"), (3, "", "", None, "allow"),
            (4, "", "", None, "allow"), (5, "ads.com", "", None, "block"), (6, "ads.com", "/fr/", "com/fr/", "allow")]


def test_language(docs, spark, sf):
    rows = docs.select("doc_id", language.predict(language.learn(docs)).alias("p")).select("doc_id", "p.*").collect()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4)} == {"und"}
    assert language.learn(docs.limit(0)) == {} and language.Judge({})("a") == ("und", 0.0)
    found = queries.op10(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = [r for r in found.collect() if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)


def test_quality(docs, spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    source = spark.read.parquet(f"{sf}/documents.parquet")
    network = quality.fit(source, labels)
    scores = [r[0] for r in docs.select(quality.score(network)).collect()]
    assert len(scores) == len(CASES) and all(0 <= s <= 1 for s in scores)
    found = source.join(labels, "doc_id").select("quality", quality.score(network).alias("s")).collect()
    assert sum((r["s"] >= 0.5) == r["quality"] for r in found) >= 0.9 * len(found)
    none = quality.fit(source, labels.limit(0))
    assert {r[0] for r in docs.select(quality.score(none)).collect()} == {0.5}


def test_empty_tables(spark):
    none = frame(spark, [])
    assert exact.find_copies(none).count() == 0 and exact.deduplicated(none).count() == 0
    assert minhash.find_near(none).count() == 0
    assert scoring.score(none.select("doc_id", "text"), none).count() == 0
    assert licenses.scan(none, S.LICENSES).count() == 0
    assert none.select(pieces.digests(S.PIECE_MODEL)).count() == 0


def test_pipeline_is_its_stages_in_plain_python(spark, sf, small):
    import pyarrow as pa
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    from kelvibra.llm.stores import remainder
    network = quality.load(quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet").filter(remainder("doc_id", 3) != 1)))
    left = {i: t for i, t in small if next(
        network.scores(quality.pooled(network, b))[0] for b in quality.W.blocks(pa.array([t]))) >= 0.5}
    first = {}
    for i in sorted(left):
        first.setdefault(space(left[i]), i)
    left = {i: left[i] for i in first.values()}
    near = [(n, c) for n, _, c in brute_near(sorted(left.items()))]
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = {n: left[n] for n, c in near if n == c and not any(len(shingles(left[n]) & s) >= 0.857 * len(s) for s in items)}
    assert set(got) == set(left)
    library = sentencepiece.SentencePieceProcessor(model_file=S.PIECE_MODEL)
    assert all(got[i]["n_tokens"] == len(library.encode(t)) for i, t in left.items())
