"""Substring dedup against all windows counted in memory."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tillroll.llm import substring


def brute(rows, n):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for (k, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - n + 1) if seen[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
        out.append((k, " ".join(x for j, x in enumerate(w) if j not in gone), len(w), len(gone)))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.doc_id, r.text, r.n_words, r.n_removed) for r in df.collect()], key=str)


def shared(seed, n=80):
    rng = random.Random(seed)
    base = [rng.choice("abc") for _ in range(80)]
    rows = []
    for k in range(n):
        w = [rng.choice("abc") for _ in range(rng.randint(0, 20))]
        if rng.random() < 0.6:
            i = rng.randint(0, 70)
            w += base[i:i + rng.randint(0, 30)] + [rng.choice("ab") for _ in range(rng.randint(0, 9))]
        rows.append((rng.choice([None, k, 1]), rng.choice([" ", "\n", "  \t"]).join(w)))
    return rows


@pytest.mark.parametrize("seed,window,gram", [(1, 7, 3), (2, 9, 9), (3, 12, 2)])
def test_matches_brute_force(docs_of, seed, window, gram):
    rows = shared(seed)
    out = substring.remove_repeats(docs_of(rows), window, gram)
    assert got(out) == brute(rows, window)
    assert [c for c in out.columns if c not in ("n_words", "n_removed")] == [c for c in docs_of(rows).columns if c != "n_words"]


def test_odd_rows(docs_of):
    assert got(substring.remove_repeats(docs_of(ODD))) == brute(ODD, 35)
    assert substring.remove_repeats(docs_of(ODD).limit(0)).count() == 0
    with pytest.raises(ValueError):
        substring.remove_repeats(docs_of(ODD), 5, 6)


def test_layout_leaves_other_text_as_it_was(docs_of):
    p = " ".join(f"p{i}" for i in range(40))
    rows = [(1, f"Start  here.\n{p}\nand\n\nend "), (2, f"{p} tail"), (3, " alone \n text ")]
    out = {r.doc_id: r.text for r in substring.remove_repeats(docs_of(rows), layout=True).collect()}
    assert out == {1: "Start  here. and\n\nend", 2: "tail", 3: " alone \n text "}


def test_common_line_in_many_documents(docs_of):
    # a hot anchor with different surroundings: 20 shared words are no window, 35 are
    line, passage = " ".join(f"l{i}" for i in range(20)), " ".join(f"q{i}" for i in range(37))
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choices("xyz", k=30)) + f" u{k} " + (passage if k % 3 == 0 else line) + f" v{k} " +
             " ".join(rng.choices("xyz", k=30))) for k in range(150)]
    assert got(substring.remove_repeats(docs_of(rows))) == brute(rows, 35)


def test_spans_of_equal_rows_are_those_of_one_text(spark):
    """50,000 equal rows of 400 words: the collected spans do not grow with the copies, and every copy loses its words."""
    from tillroll.llm.common import Scratch, text_bytes, text_hash

    text = " ".join(f"w{i * i % 977}x{i}" for i in range(400))

    def rows(n):
        return spark.range(n).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit(text).alias("text"))

    def longest(n):
        src = rows(n).select(F.col("doc_id").alias("key"), text_hash(F.col("text")).alias("th"), text_bytes("text").alias("body"),
                             F.lit(None).cast("int").alias("rest"))
        return substring.repeated_spans(src, Scratch(spark), 35, 8).agg(F.max(F.size("first"))).first()[0]

    assert longest(50_000) == longest(2) <= 400
    out = substring.remove_repeats(rows(50_000), window=35).agg(F.count("*"), F.min("n_removed"), F.max("text")).first()
    assert tuple(out) == (50_000, 400, "")
