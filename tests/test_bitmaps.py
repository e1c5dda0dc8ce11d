"""Exact distinct customers from bitmaps against COUNT(DISTINCT)."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tillroll.operators import bitmaps as M
from tillroll.sources.tables import star_tables

SF = "/root/testdata/sf0.001"


def orders(spark, seed, n=3000):
    rng = random.Random(seed)
    ids = [0, -1, -32767, -32768, -32769, 1, 32767, 32768, 32769, 65536, 2**40, -2**40, 2**63 - 1, None] + list(range(100, 130))
    rows = [(dt.datetime(2022, 1, 1) + dt.timedelta(days=rng.randint(0, 800)), rng.choice(ids)) for _ in range(n)]
    return spark.createDataFrame(rows + [(None, 5), (None, None)], "ordered_at timestamp_ntz, customer_id bigint").repartition(5)


def counted(df, period):
    return {(r.p, r.n) for r in df.groupBy(period.alias("p")).agg(F.countDistinct("customer_id").alias("n")).collect() if r.n}


def test_every_level_equals_count_distinct(spark):
    df = orders(spark, 1)
    got = {}
    for r in M.unique_customers(df).collect():
        got.setdefault(r.level, set()).add((r.period, r.unique_customers))
    t = F.col("ordered_at")
    assert got["month"] == counted(df, F.date_format(t, "yyyy-MM"))
    assert got["quarter"] == counted(df, F.concat(F.year(t).cast("string"), F.lit("-Q"), F.quarter(t).cast("string")))
    assert got["year"] == counted(df, F.year(t).cast("string"))
    assert got["total"] == counted(df, F.lit("all"))


def test_bitmaps_merge(spark):
    a, b = orders(spark, 2, 500), orders(spark, 3, 500)
    one = M.unique_ids(M.merge(M.customer_bitmaps(a), M.customer_bitmaps(b), M.customer_bitmaps(a)))
    both = M.unique_customers(a.unionByName(b))
    assert sorted(map(repr, map(tuple, one.collect()))) == sorted(map(repr, map(tuple, both.collect())))
    assert M.unique_customers(a.limit(0)).count() == 0


def test_one_pass_without_expand(spark):
    plan = M.unique_customers(star_tables(spark, SF).orders)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("FileScan") == 1
