"""Hard negatives against brute force over all pairs, and the bounds against exact scores."""
from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import negatives as N

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank int, score string, ints string, dim string"


def brute(rows, every=5, positives=5, negatives=3):
    kept = [(i, v, l, [math.floor(256 * float(np.float32(x))) for x in e]) for i, (v, e, l) in enumerate(rows)
            if e is not None and l is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = Counter()
    big = 1 << 62
    for i, v, l, x in kept:
        if v is None or v % every:
            continue
        all_ = sorted((-sum(a * b for a, b in zip(x, y)), big if w is None else w, j, m) for j, w, m, y in kept
                      if j != i and len(y) == len(x))
        for s, w, _, _ in [t for t in all_ if t[3] == l][:positives]:
            near = [t for t in all_ if t[3] != l and 50 * -s <= 100 * -t[0] <= 95 * -s][:negatives]
            for rank, t in enumerate(near, 1):
                out[v, None if w == big else w, rank, None if t[1] == big else t[1], -s, -t[0]] += 1
    return out


def run(spark, rows, every=5):
    df = spark.createDataFrame([(v, e, l, 1, "s", "i", "d") for v, e, l in rows], SCHEMA).repartition(3)
    return Counter(tuple(r) for r in N.mine(df, F.col("vec_id") % every == 0).collect())


def clusters(n, dim, seed, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, dim))
    x = centre[rng.integers(0, 6, n)] * 0.3 + rng.normal(size=(n, dim)) * 0.15
    return [(int(i), [float(a) for a in v], int(l)) for i, v, l in zip(range(n), x, rng.integers(0, labels, n))]


@pytest.mark.parametrize("dim", [3, 64, 100])
def test_agrees_with_brute_force(spark, dim, monkeypatch):
    monkeypatch.setattr(N, "ROWS", 90)
    monkeypatch.setattr(N, "ANCHORS", 20)
    rows = clusters(400, dim, dim)
    got = run(spark, rows)
    assert got == brute(rows) and len(got) > 100


def test_odd_rows(spark):
    rows = clusters(60, 4, 1) + clusters(40, 4, 1)                       # repeated rows and ties
    rows += [(200, None, 1), (205, [1.0, None, 0.0, 0.0], 1), (210, [float("nan"), 0, 0, 0], 1), (215, [float("inf"), 0, 0, 0], 2),
             (220, [0.1, 0.2, 0.3, 0.4], None), (None, [0.4, 0.3, 0.2, 0.1], 1), (None, [0.4, 0.3, 0.2, 0.1], 2), (225, [], 1),
             (230, [], 2), (235, [0.0] * 4, 1), (240, [0.0] * 4, 2), (245, [1.0, 1.0], 1), (246, [1.0, 1.0], 2), (247, [1.0, 0.8], 1),
             (250, [9e4, 9e4, 9e4, 9e4], 1), (251, [9e4, 9e4, 9e4, 8e4], 1), (252, [9e4, 9e4, 5e4, 5e4], 2)]
    rows = [(v, None if e is None else [None if x is None else float(x) for x in e], l) for v, e, l in rows]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == Counter()
    assert run(spark, [(0, [1.0], 1)]) == Counter()


def test_equal_vectors_of_one_hot_label(spark):
    rows = [(i, [0.5, 0.25, -0.5], 1 if i % 3 else 2) for i in range(120)] + [(500 + i, [0.5, 0.1, -0.3 + i / 100], 2) for i in range(30)]
    assert run(spark, rows) == brute(rows)


def test_whole_numbers_beyond_doubles():
    a, b = np.array([[2.0 ** 30, 3.0, 1.0]]), np.array([2.0 ** 30, 1.0, 2.0])
    assert N.scores(a, b).tolist() == [2 ** 60 + 5]


@pytest.mark.parametrize("dim", [1, 5, 64, 130])
def test_intervals_hold_the_scores(dim):
    rng = np.random.default_rng(dim)
    x = np.floor(rng.normal(size=(300, dim)) * rng.choice([1, 50, 5000], (300, 1)))
    x[:3] = 0
    probes = N.Probes(x[:40])
    est, half = probes.bounds(np.arange(40), *N.codes(x))
    exact = x[:40] @ x.T
    assert (np.abs(est - exact) <= half).all()
    norm = np.linalg.norm(x, axis=1)
    ok = norm > 0
    assert np.median(half[ok[:40]][:, ok] / (norm[:40][ok[:40], None] * norm[ok])) < (0.3 if dim > 4 else 1.1)


def test_rotation_keeps_inner_products():
    x = np.floor(np.random.default_rng(0).normal(size=(50, 70)) * 256)
    y = N.rotate(x)
    assert y.shape == (50, 128) and np.allclose(y @ y.T, x @ x.T, rtol=1e-12)
