"""Exact rounded ratios: Spark helper == DuckDB helper == Python Fractions."""

from __future__ import annotations

import random
from decimal import Decimal
from fractions import Fraction

import duckdb
from pyspark.sql import functions as F

from tillroll.functions.numeric import round_div, round_div_decimal
from tillroll.plans.oracle import rdiv, rdiv_dec


def _expected(num: Fraction, den: Fraction, digits: int, factor: int):
    if den == 0:
        return None
    q = Fraction(factor) * num / den * 10 ** digits
    sign = -1 if q < 0 else 1
    q = abs(q)
    whole = q.numerator // q.denominator
    if q - whole >= Fraction(1, 2):      # half away from zero
        whole += 1
    return sign * whole / 10 ** digits


def _cases(n=400, seed=7):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        ns, ds = rnd.choice([(2, 0), (2, 2), (0, 0)])
        digits, factor = rnd.choice([(0, 1), (1, 1), (1, 100), (2, 1)])
        a = rnd.randint(-10 ** 9, 10 ** 9)
        b = rnd.choice([0, rnd.randint(-5000, 5000), rnd.randint(1, 8), 2 * 10 ** rnd.randint(0, 3)])
        if rnd.random() < 0.3:   # force an exact tie at the rounding digit
            b = 2 * rnd.randint(1, 50)
            a = b * rnd.randint(-1000, 1000) + b // 2
        out.append((a, b, ns, ds, digits, factor))
    return out


def test_round_div_agrees(spark):
    cases = _cases()
    combos = sorted({c[2:] for c in cases})
    rows = [(i, combos.index(c[2:]), Decimal(c[0]).scaleb(-c[2]), Decimal(c[1]).scaleb(-c[3]))
            for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, k int, a decimal(30,2), b decimal(30,2)")
    parts = [df.where(F.col("k") == k).select("i", round_div(F.col("a"), F.col("b"), digits, factor, ns, ds)
                                              .alias("v"))
             for k, (ns, ds, digits, factor) in enumerate(combos)]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    spark_out = {r["i"]: r["v"] for r in union.collect()}
    con = duckdb.connect()
    for i, (a, b, ns, ds, digits, factor) in enumerate(cases):
        na, nb = Decimal(a).scaleb(-ns), Decimal(b).scaleb(-ds)
        exp = _expected(Fraction(na), Fraction(nb), digits, factor)
        expf = None if exp is None else float(exp)
        duck = con.execute(
            f"SELECT {rdiv('a', 'b', digits, factor, ns, ds)} FROM "
            f"(SELECT CAST('{na}' AS DECIMAL(30,2)) AS a, CAST('{nb}' AS DECIMAL(30,2)) AS b)").fetchone()[0]
        assert spark_out[i] == expf, (a, b, ns, ds, digits, factor, spark_out[i], expf)
        assert duck == expf, (a, b, ns, ds, digits, factor, duck, expf)


def test_round_div_decimal(spark):
    df = spark.createDataFrame([(Decimal("10.05"), 2), (Decimal("-10.05"), 2), (Decimal("1.00"), 3)],
                               "a decimal(18,2), q int")
    got = [r[0] for r in df.select(round_div_decimal(F.col("a"), F.col("q"), 2, num_scale=2)).collect()]
    assert got == [Decimal("5.03"), Decimal("-5.03"), Decimal("0.33")]
    con = duckdb.connect()
    assert con.execute(f"SELECT {rdiv_dec('CAST(10.05 AS DECIMAL(18,2))', '2', 2, 2, 0)}").fetchone()[0] \
        == Decimal("5.03")
