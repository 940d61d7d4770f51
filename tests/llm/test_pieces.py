"""Words merged many at once, and what their ids decode to, against the sentencepiece library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from kelvibra.llm import pieces
from kelvibra.llm import settings as S

HARD = ["", None, " ", "a", "  two  blanks ", "<0x41>", " a", "a ", "▁ ▁a", "日本語 テスト 😀😀 x", "\x00 <unk> é", "end.\nBegin\r\n\tx",
        "x" * 300_000, "é" * 70 + " " + "ab" * 31, "\U0010ffff ퟿", "naïve café", "��"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=S.PIECE_MODEL)


@pytest.fixture()
def coder():
    return pieces.Coder(pieces.Model(S.PIECE_MODEL))


def test_all_texts_of_a_table(spark, library, coder):
    """Every text of sf0.01, in the blocks in which a job meets them."""
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()] + HARD
    for text, (ids, count, back, ends) in zip(texts, coder.all(pa.array(texts, pa.string()))):
        want = library.encode(text or "")
        assert ids == ",".join(map(str, want)) and count == len(want) == len(ends)
        assert back == library.decode(want)
        assert not count or ends[-1] == len((text or "").encode())


def test_spans_of_merged_words(coder):
    for text, (_, _, _, ends) in zip(HARD, coder.all(pa.array(HARD, pa.string()))):
        if len(text or "") < 1000:
            assert [e for _, e in coder.model.encode(text or "")[1]] == ends.tolist()


def test_a_wrong_id_shows_in_the_text(coder):
    word = coder.merger.merge(["▁reading"])[0]
    coder.seen["reading"] = (word[0], word[1], "riding")
    assert next(coder.all(pa.array(["a reading"])))[2] == "a riding"  # the text is that of the ids, not the word


def test_forgotten_words_come_back(coder, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    monkeypatch.setattr(pieces, "BLOCK_ROWS", 3)
    monkeypatch.setattr(pieces, "AT_ONCE", 7)
    rng = random.Random(1)
    texts = [" ".join(f"wörd{rng.randrange(60)}" for _ in range(20)) for _ in range(40)]
    for text, (ids, *_) in zip(texts, coder.all(pa.array(texts))):
        assert ids == ",".join(str(i) for i in coder.model.encode(text)[0])


def test_merging_many_is_merging_one(coder):
    rng = random.Random(2)
    words = ["▁" + "".join(rng.choice("aeinrstlöß-'0.") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for word, (ids, sizes, _) in zip(words, coder.merger.merge(words)):
        numbers = coder.model.piece_ids(coder.model._merge_long(word))
        assert ids == ",".join(str(i) for i, _ in numbers) and len(sizes) == len(numbers)


def test_encoded_rows_hold_what_their_digests_say(spark, library):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)], "doc_id long, text string").coalesce(1)
    rows = docs.select("text", pieces.encoded(S.PIECE_MODEL, keep=False).alias("e"), pieces.digests(S.PIECE_MODEL).alias("d")) \
        .select("text", "e.*", "d", pieces.decoded(S.PIECE_MODEL, "e.ids").alias("back")).collect()
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["spans_sha256"]) == tuple(r["d"])
        assert r["ids"] == library.encode(r["text"] or "") and r["back"] == library.decode(r["ids"])
        assert len(r["ends"]) == r["n_tokens"] and r["ends"] == sorted(r["ends"])
        assert hashlib.sha256(np.array(r["ends"], np.int64).tobytes()).hexdigest() == r["spans_sha256"]
        assert hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest() == r["ids_sha256"]
