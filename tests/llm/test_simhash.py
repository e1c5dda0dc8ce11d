"""SimHash near-dedup against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from tests.llm.conftest import ODD
from tillroll.llm import simhash


def brute_fingerprint(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups_of(rows, distance=2):
    """(fingerprints, number of each row's group)."""
    fp = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    of = list(range(len(rows)))

    def find(i):
        while of[i] != i:
            i = of[i]
        return i
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fp[i + 1:] ^ fp[i]) <= distance):
            of[find(i + 1 + int(j))] = find(i)
    return fp, [find(i) for i in range(len(rows))]


def brute(rows):
    """Sorted (key, fingerprint, component)."""
    fp, group = groups_of(rows)
    members = {}
    for (k, _), g in zip(rows, group):
        members.setdefault(g, []).append(k)
    least = {g: min([k for k in ks if k is not None], default=None) for g, ks in members.items()}
    return sorted([(k, int(f), least[g]) for (k, _), f, g in zip(rows, fp, group)], key=str)


def got(df):
    return sorted([(r[0], r.fingerprint % 2**64, r.component_id) for r in df.collect()], key=str)


def near_texts(n, seed=1):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(600)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append((k, " ".join(w)))
    return out + [(n + k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for k in range(40)]


def test_components_match_brute_force(docs_of):
    rows = near_texts(60) + [(500, "same text here again"), (401, "SAME text here again"), (402, "same text here again")]
    assert got(simhash.near_duplicates(docs_of(rows))) == brute(rows)


def test_odd_rows(docs_of):
    assert got(simhash.near_duplicates(docs_of(ODD))) == brute(ODD)
    assert simhash.near_duplicates(docs_of(ODD).limit(0)).count() == 0


def test_anchors_join_all_pairs_within_two_bits():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**64, 200, dtype=np.uint64)
    for flips in (0, 1, 2):
        y = x.copy()
        for i in range(len(x)):
            for b in rng.choice(64, flips, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(b)
        (ix, ax), (iy, ay) = simhash.anchors(x, 2), simhash.anchors(y, 2)
        for i in range(len(x)):
            assert set(ax[ix == i]) & set(ay[iy == i])
        near = np.bitwise_count(ax ^ x[ix])
        assert near.max() <= 1 + 2   # covering radius plus threshold
    assert (simhash.nearest_anchor(simhash.nearest_anchor(x)) == simhash.nearest_anchor(x)).all()


def test_chain_of_links_is_one_component(spark):
    # values that differ by one bit from the one before: all linked, ends far apart
    chain = [0]
    for b in range(60):
        chain.append(chain[-1] | 1 << b)
    distinct = spark.createDataFrame([(v,) for v in chain], "fp bigint")
    from tillroll.llm.common import Scratch
    label = simhash.components(simhash.links(distinct, 2), Scratch(spark)).collect()
    assert {r.fp for r in label} == set(chain) and {r.root for r in label} == {0}


def test_large_group_makes_few_links(spark):
    # all 2081 values within two bits of one: links must not be all pairs
    ball = {0} | {1 << a for a in range(64)} | {1 << a | 1 << b for a in range(64) for b in range(a)}
    distinct = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in ball], "fp bigint")
    edges = simhash.links(distinct, 2)
    n = edges.count()
    assert 2080 <= n < 60 * len(ball)


def test_keep_one_keeps_one_row_of_each_group(docs_of):
    rows = near_texts(20) + ODD
    kept = simhash.keep_one(docs_of(rows))
    assert "anchor" in kept.columns and kept.columns == docs_of(rows).columns
    ids = [r.doc_id for r in kept.collect()]
    members = {}
    for (k, _), g in zip(rows, groups_of(rows)[1]):
        members.setdefault(g, []).append(k)
    least = [min([k for k in ks if k is not None], default=None) for ks in members.values()]
    assert sorted(ids, key=str) == sorted(least, key=str)
