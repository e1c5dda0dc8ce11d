"""BPE ids and decoded texts against the library on whole texts."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import ODD
from tillroll.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = ["a", "b", "the", "ing", "'s", "'t", " ", "  ", "\n", "é", "é", "́", "ß", "日",
            "\U0001F600", "<|endoftext|>", "<|startoftext|>", "<|END", "Σ", "ΑΣ", "!!", "12",
            " ", "　", "İ", "...", "$$$"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def compare(df, rows, library):
    out = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    want = sorted(((k, tuple(library.encode(t or "", add_special_tokens=False).ids)) for k, t in rows), key=str)
    assert sorted(((r.doc_id, tuple(r.ids)) for r in out), key=str) == want
    assert all(library.decode(list(r.ids), skip_special_tokens=False) == r.decoded for r in out)
    both = bpe.encode(df, PATH, decoded=True).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in both) == sorted((str(r.doc_id), r.decoded) for r in out)


def test_shared_chunks_and_cuts_inside_words(docs_of, library):
    rng = random.Random(5)
    passage = "".join(rng.choice(ALPHABET) for _ in range(4000))
    rows = []
    for i in range(40):
        t = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 900)))
        if i % 3 == 0:
            a = rng.randint(0, 3000)
            t += passage[a:a + rng.randint(0, 4000)] + t[:50]
        rows.append((i, t))
    rows += [(100, "x" * 50000), (101, "日本" * 9000 + " " + "ab" * 9000), (102, "x" * 50000), (None, passage),
             (None, passage), (5, passage), (105, "Der " * 5000), (106, "é" * 30000 + " it's"),
             (107, "a" * 8190 + "́b" * 5000)]
    compare(docs_of(rows), rows, library)


def test_odd_rows(docs_of, library):
    compare(docs_of(ODD), ODD, library)
    compare(docs_of(ODD).limit(0), [], library)


def test_a_word_cut_in_two_is_repaired(library):
    e = bpe.Encoder(PATH)
    for text in ("start " + "abcdefghij" * 2500 + " end of it", "z" * 40000, "a b " * 20 + "q" * 20000 + " c d"):
        data = text.encode()
        at = bpe.cuts(data)
        assert at and any(data[c - 1:c] != b" " for c in at)
        bounds = [0, *at, len(data)]
        pieces = [e.direct([data[a:b]])[0] for a, b in zip(bounds, bounds[1:])]
        want = library.encode(text, add_special_tokens=False).ids
        assert list(bpe.np.frombuffer(e.assemble([data], [{}])[0], e.kind)) == want
        assert list(bpe.np.frombuffer(e.assemble([data], [dict(enumerate(pieces))])[0], e.kind)) == want


def test_cuts_follow_the_content():
    rng = random.Random(9)
    passage = " ".join("".join(rng.choices("abcdef", k=6)) for _ in range(4000)).encode()
    chunks = lambda d: {d[a:b] for a, b in zip([0, *bpe.cuts(d)], [*bpe.cuts(d), len(d)])}
    mine, other = chunks(passage), chunks(b"some other beginning " + passage[137:])
    assert len(mine & other) > 0.8 * len(mine)


def test_cache_is_bounded(library):
    e = bpe.Encoder(PATH)
    e.CACHE = 100
    texts = [" ".join(f"w{i * 37 + j}" for j in range(60)).encode() for i in range(20)]
    for t in texts:
        assert list(bpe.np.frombuffer(e.assemble([t], [{}])[0], e.kind)) == library.encode(
            t.decode(), add_special_tokens=False).ids
    assert len(e.cache) <= 200
