"""Distributed exact ordering == Spark's single-partition windows."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators.ordering import OrderSpec, _plan, global_ntiles, global_order


def _frame(spark, n, kind, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if kind == "heavy":          # one value holds about a third of the rows
            v = 7 if rnd.random() < 0.34 else rnd.randint(0, 40)
        elif kind == "few":
            v = rnd.randint(1, 3)
        else:
            v = rnd.randint(-1000, 1000)
        if rnd.random() < 0.05:
            v = None
        rows.append((i * 3 + 1, v, None if v is None else Decimal(v) / 4))
    return spark.createDataFrame(rows, "id long, v long, d decimal(18,2)")


CASES = [(0, "spread"), (1, "spread"), (3, "few"), (4, "few"), (7, "heavy"),
         (997, "heavy"), (1000, "spread"), (1425, "few")]


@pytest.mark.parametrize("n,kind", CASES)
@pytest.mark.parametrize("desc", [False, True])
def test_order_matches_window(spark, n, kind, desc):
    df = _frame(spark, n, kind, n + (7 if desc else 0))
    key = F.col("d").desc() if desc else F.col("d").asc()
    w = Window.orderBy(key, F.col("id"))
    expected = (df.withColumn("rn", F.row_number().over(w))
                .withColumn("rk", F.rank().over(Window.orderBy(key)))
                .withColumn("rs", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("nt", F.ntile(5).over(w))
                .select("id", "rn", "rk", "rs", "nt").collect())
    got = global_order(df, "d", descending=desc, tiebreak="id", sum_col="d", buckets=8)
    got = got.select("id", "row_number", "rank", F.col("running_sum").cast("decimal(38,2)")).collect()
    nt = global_ntiles(df, [("d", desc, "nt")], 5, tiebreak="id", buckets=8).select("id", "nt").collect()
    exp = {r["id"]: (r["rn"], r["rk"], r["rs"], r["nt"]) for r in expected}
    ntd = {r["id"]: r["nt"] for r in nt}
    assert len(got) == n
    for r in got:
        e = exp[r["id"]]
        assert (r["row_number"], r["rank"]) == (e[0], e[1])
        assert r[3] == e[2]
        assert ntd[r["id"]] == e[3]


def test_rank_without_tiebreak(spark):
    df = _frame(spark, 500, "heavy", 3)
    exp = {r["id"]: r["rk"] for r in df.withColumn(
        "rk", F.rank().over(Window.orderBy(F.col("v").desc()))).collect()}
    got = global_order(df, "v", descending=True, buckets=8).select("id", "rank").collect()
    assert {r["id"]: r["rank"] for r in got} == exp


def test_hot_value_is_split(spark):
    """A value holding a third of all rows is spread over several buckets."""
    rows = [(i, 5 if i % 3 == 0 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v long")
    work, plans = _plan(df, [OrderSpec("v")], "id", 16, "t")
    hot = work.where("v = 5").select(plans[0].bucket.alias("b")).distinct().count()
    assert hot >= 4, hot
    out = global_order(df, "v", tiebreak="id", buckets=16, materialize=False)
    exp = {r["id"]: r["rn"] for r in df.withColumn(
        "rn", F.row_number().over(Window.orderBy("v", "id"))).collect()}
    assert {r["id"]: r["row_number"] for r in out.collect()} == exp


def test_no_single_partition_exchange_for_rows(spark):
    df = _frame(spark, 200, "spread", 1)
    out = global_ntiles(df, [("v", False, "t")], 5, tiebreak="id", buckets=8, materialize=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("buckets", [2, 3, 64])
def test_bucket_count_does_not_change_results(spark, buckets):
    df = _frame(spark, 600, "heavy", buckets)
    w = Window.orderBy(F.col("v").desc_nulls_last(), F.col("id"))
    exp = {r["id"]: (r["rn"], r["rk"]) for r in df.withColumn("rn", F.row_number().over(w)).withColumn(
        "rk", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last()))).collect()}
    got = global_order(df, "v", descending=True, tiebreak="id", buckets=buckets)
    assert {r["id"]: (r["row_number"], r["rank"]) for r in got.collect()} == exp


def test_nulls_first_on_descending(spark):
    df = _frame(spark, 300, "few", 11)
    w = Window.orderBy(F.col("v").desc_nulls_first(), F.col("id"))
    exp = {r["id"]: r["rn"] for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    got = global_order(df, "v", descending=True, nulls_first=True, tiebreak="id", buckets=8)
    assert {r["id"]: r["row_number"] for r in got.collect()} == exp


def test_hot_decimal_of_many_digits_is_split(spark):
    hot = "12345678901234567.89"
    df = spark.range(40_000).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise(F.col("id").cast("string")).cast("decimal(20,2)").alias("v"))
    _, plans = _plan(df, [OrderSpec("v")], "id", 16, "t")
    assert max(rows for _, _, rows in plans[0].starts) < 6000
    out = global_order(df, "v", tiebreak="id", buckets=16)
    assert out.where(F.col("v") == F.lit(hot).cast("decimal(20,2)")).agg(F.min("rank"), F.max("rank"), F.max("row_number")).collect()[0] == (20001, 20001, 40000)


def test_tiles_from_cut_points_match_the_window(spark):
    for n in (0, 1, 3, 5, 7, 23, 400):
        df = spark.range(n).select("id", F.when(F.col("id") % 7 == 3, None).otherwise(F.col("id") % 4).alias("v"))
        for desc in (False, True):
            order = F.col("v").desc() if desc else F.col("v").asc()
            want = {r.id: r.t for r in df.withColumn("t", F.ntile(5).over(Window.orderBy(order, "id"))).collect()}
            got = {r.id: r.t for r in global_ntiles(df, [("v", desc, "t")], 5, tiebreak="id", buckets=8).collect()}
            assert got == want, (n, desc)


@pytest.mark.parametrize("kind", ["spread", "heavy", "few"])
def test_the_look_up_of_many_boundaries(spark, kind, monkeypatch):
    """The paths that large inputs take: boundaries found in an array, and none left out for few rows."""
    from tillroll.operators import ordering
    df = _frame(spark, 1200, kind, 3)
    w = Window.orderBy(F.col("d").asc(), F.col("id"))
    want = sorted(map(tuple, df.select("id", F.row_number().over(w).cast("long"), F.rank().over(Window.orderBy("d")).cast("long")).collect()))
    monkeypatch.setattr(ordering, "_TREE_MAX", 3)
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 1)
    got = global_order(df, "d", tiebreak="id", buckets=90)
    assert sorted(map(tuple, got.select("id", "row_number", "rank").collect())) == want
    tiles = global_ntiles(df, [("d", False, "t")], 5, tiebreak="id", buckets=90)
    assert sorted(map(tuple, tiles.select("id", "t").collect())) == sorted(
        map(tuple, df.select("id", F.ntile(5).over(w).cast("long")).collect()))
    lag = ordering.global_lag(df, "d", {"v": "before"}, tiebreak="id", buckets=90)
    assert sorted(map(repr, map(tuple, lag.select("id", "before").collect()))) == sorted(
        map(repr, map(tuple, df.select("id", F.lag("v").over(w)).collect())))
