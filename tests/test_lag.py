"""LAG over all rows against Spark's unpartitioned window."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators.ordering import global_lag


def check(df, key, descending=False, nulls_first=None, buckets=None, values=None):
    values = values or {"x": "prev_x", "id": "prev_id"}
    got = global_lag(df, key, values, tiebreak="id", descending=descending, nulls_first=nulls_first, buckets=buckets)
    first = (not descending) if nulls_first is None else nulls_first
    c = F.col(key)
    order = {(False, True): c.asc_nulls_first(), (False, False): c.asc_nulls_last(),
             (True, True): c.desc_nulls_first(), (True, False): c.desc_nulls_last()}[descending, first]
    w = Window.orderBy(order, "id")
    want = df.select("*", *[F.lag(a).over(w).alias(b) for a, b in values.items()])
    assert got.columns == want.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    return got


def some(spark, seed, n, make):
    rng = random.Random(seed)
    rows = [(i, make(rng), rng.choice([None, "a", "b", "c"])) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,buckets", [(0, 4), (1, 4), (2, 4), (500, 1), (800, 40)])
def test_ties_nulls_and_directions(spark, n, buckets):
    rows = some(spark, n, n, lambda r: r.choice([None, None, 1, 1, 1, 2, 3, r.randint(0, 50)]))
    df = spark.createDataFrame(rows, "id bigint, k bigint, x string").repartition(4)
    for descending in (False, True):
        for nulls_first in (None, True, False):
            check(df, "k", descending, nulls_first, buckets)


def test_one_key_for_nearly_all_rows(spark):
    rows = some(spark, 7, 900, lambda r: 5 if r.random() < 0.8 else r.randint(0, 9))
    check(spark.createDataFrame(rows, "id bigint, k bigint, x string").repartition(4), "k", buckets=30)


def test_times_dates_and_decimals(spark):
    t0 = dt.datetime(1969, 12, 31, 23)
    rows = [(i, t0 + dt.timedelta(microseconds=(i * 7919) % 13, hours=i % 5), dt.date(1960 + i % 30, 1, 1), D(i % 11) / 7 * D("1.0"), "v")
            for i in range(300)] + [(1000, None, None, None, "n")]
    df = spark.createDataFrame(rows, "id bigint, t timestamp_ntz, d date, m decimal(18,4), x string").repartition(3)
    for key in "tdm":
        check(df, key, buckets=20)
        check(df, key, True, buckets=20)


def test_no_single_partition(spark):
    df = spark.range(1000).select("id", (F.col("id") * 37 % 101).alias("k"), F.lit("v").alias("x"))
    got = check(df, "k", buckets=16)
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
