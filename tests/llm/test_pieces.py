"""SentencePiece encoding through the table of distinct words, against the library on whole texts."""
from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tillroll.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def expected(sp, given):
    return sorted(((k, sp.encode(t or ""), sp.decode(sp.encode(t or "")) if t else "") for k, t in given), key=repr)


def got(df):
    return sorted(((r.doc_id, list(r.ids), r.decoded) for r in df.collect()), key=repr)


def test_whole_texts_as_the_library(docs_of, sp):
    rng = random.Random(9)
    bits = ["a", "the", "Ä", "日本", "\U0001F600", " ", "  ", "\n", "▁", "<s>", "</s>", "<0x0A>", "\x00", "\t", "ing", "　", "ﬁ", "́"]
    given = ODD + [(i, "".join(rng.choices(bits, k=rng.randint(0, 30)))) for i in range(20, 620)]
    given += [(i, t) for i, t in enumerate([" ", "  ", "a ", "a  ", " a", "▁", "▁▁ ", "a▁b", "\n", " \n ", "\n\n x"], 700)]
    df = docs_of(given).repartition(5)
    want = expected(sp, given)
    assert got(pieces.encode(df, MODEL, decoded=True)) == want
    assert got(pieces.encode(df, MODEL, decoded=True, block=300)) == want       # many blocks, long texts alone in one
    only = pieces.encode(df, MODEL)
    assert got(pieces.decode(only, MODEL)) == want


def test_empty_table(docs_of):
    assert pieces.encode(docs_of([]), MODEL, decoded=True).collect() == []
    assert [r.ids for r in pieces.encode(docs_of([(1, None), (1, "")]), MODEL).collect()] == [[], []]


def test_buckets_of_bounded_size_answer_all_blocks(docs_of, sp, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS", 50)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    given = [(i, " ".join(["the"] * 20 + rng.choices(words, k=30))) for i in range(60)]
    assert got(pieces.encode(docs_of(given).repartition(3), MODEL, decoded=True, block=900)) == expected(sp, given)
    monkeypatch.setattr(pieces, "BUCKETS", 3)                       # few buckets of many words
    assert got(pieces.encode(docs_of(given).repartition(3), MODEL, decoded=True, block=900)) == expected(sp, given)


def test_each_distinct_word_is_segmented_once(spark, docs_of, tmp_path, monkeypatch):
    """Words are logged by the segmenter itself: over all blocks, buckets and workers none comes twice."""
    log = str(tmp_path)

    class Logged(pieces.Segmenter):
        def ids(self, words):
            import uuid
            if not words:
                return []
            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(w.decode() for w in words))
            return super().ids(words)

    monkeypatch.setattr(pieces, "segmenter", lambda path: Logged(path))
    given = [(i, f"one two two three w{i % 7}") for i in range(200)]
    rows = pieces.encode(docs_of(given).repartition(4), MODEL, block=100).select(F.size("ids")).collect()
    assert len(rows) == 200
    seen = [w for f in tmp_path.iterdir() for w in f.read_text().split("\n")]
    assert sorted(seen) == sorted({"one", "two", "three", *[f"w{i}" for i in range(7)]})


def test_models_that_are_not_by_word_take_whole_texts(sp):
    seg = pieces.Segmenter(MODEL)
    assert seg.by_word
    seg.by_word = False
    for t in ("a  b", " ", "x ▁ y\n"):
        assert seg.ids(seg.words(t.encode())) == [sp.encode(t)]
