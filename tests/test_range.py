"""Ranges and clocks: sums far beyond BIGINT, and results that no session time zone changes."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillroll.functions.dates import epoch_micros, iso_datetime, micros_between, month_key
from tillroll.functions.numeric import round_div
from tillroll.operators.facts import MICROS
from tillroll.plans import clv, cohort
from tillroll.sources.tables import star_tables


def _copied(spark, tmp_path, times: int) -> str:
    """The sf0.1 tables of orders, lines and customers ``times`` over, keys shifted."""
    src, out = "/root/testdata/sf0.1", str(tmp_path / "many")
    shift = {"customer": ["c_custkey"], "orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey"]}
    for t in "region nation customer supplier part orders lineitem events".split():
        df = spark.read.parquet(f"{src}/{t}.parquet")
        if t in shift:
            df = df.crossJoin(spark.range(times).withColumnRenamed("id", "_copy"))
            for c in shift[t]:
                df = df.withColumn(c, F.col(c) + F.col("_copy") * 10_000_000)
            df = df.drop("_copy")
        df.write.parquet(f"{out}/{t}.parquet")
    return out


def test_segment_clv_on_ten_times_the_bench_data(spark, tmp_path):
    one = {r.segment: r for r in clv.segment_clv(star_tables(spark, "/root/testdata/sf0.1")).collect()}
    many = {r.segment: r for r in clv.segment_clv(star_tables(spark, _copied(spark, tmp_path, 10))).collect()}
    for s, r in one.items():
        assert many[s].customers == 10 * r.customers
        for c in ("avg_clv", "avg_orders", "avg_order_value", "avg_lifespan_days", "max_clv", "predicted_annual_clv", "clv_index"):
            assert getattr(many[s], c) == pytest.approx(getattr(r, c), abs=0.011), (s, c)


def test_sums_of_a_hundred_billion_lines(spark):
    # 1e11 lines, five days to ship each: given as sums of 1e8 lines
    each = 5 * 86_400_000_000
    ot = spark.range(1000).select(F.lit(str(each * 10**8)).cast(MICROS).alias("ship"), F.lit(10**8).alias("lines"))
    s = ot.agg(F.sum("ship").alias("ship"), F.sum("lines").alias("lines"))
    r = s.select(round_div(F.col("ship"), F.col("lines").cast("decimal(20,0)") * F.lit(86_400_000_000), 1).alias("d")).collect()
    assert r[0].d == 5.0
    # money: 1e11 lines of 100,000.00
    r = spark.range(1000).select(F.lit("10000000000000.00").cast("decimal(28,2)").alias("v")).agg(F.sum("v").alias("v")).select(
        round_div(F.col("v"), F.lit(10**11), 2, num_scale=2).alias("a")).collect()
    assert r[0].a == 100_000.0


def test_hot_order_ship_time(spark):
    df = spark.range(20_000).select(F.lit("2024-03-01 00:00:00").cast("timestamp_ntz").alias("t"))
    got = df.agg(F.sum(epoch_micros(F.col("t"))).alias("s")).collect()[0].s
    assert int(got) == 20_000 * 1_709_251_200_000_000


@pytest.mark.parametrize("zone", ["UTC", "Africa/Johannesburg", "America/New_York"])
def test_clock_arithmetic_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        a, b = dt.datetime(2024, 3, 10, 1, 30), dt.datetime(2024, 3, 10, 3, 30, 0, 250)   # New York skips an hour here
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 01:30:00' a, TIMESTAMP_NTZ'2024-03-10 03:30:00.00025' b, "
                       "TIMESTAMP_NTZ'2024-03-10 02:15:00' gap, TIMESTAMP_NTZ'1969-12-31 23:59:59.5' old")
        r = df.select(micros_between(F.col("b"), F.col("a")), iso_datetime(F.col("gap")), month_key(F.col("gap")),
                      epoch_micros(F.col("old"))).collect()[0]
        assert (int(r[0]), r[1], r[2], int(r[3])) == ((b - a) // dt.timedelta(microseconds=1), "2024-03-10 02:15:00", "2024-03", -500_000)
        rows = {x.channel: x for x in E.queries()["channel_quality"](spark, "/root/testdata/sf0.001").collect()}
        assert spark.conf.get("spark.sql.session.timeZone") == zone   # a query leaves the session's settings alone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    want = {x.channel: x for x in E.queries()["channel_quality"](spark, "/root/testdata/sf0.001").collect()}
    assert rows == want and not any(math.isnan(x.avg_days_to_ship) for x in want.values())


def test_guest_orders_are_in_no_cohort(spark):
    from types import SimpleNamespace

    orders = spark.createDataFrame(
        [(1, 7, "completed", "2023-01-05 10:00:00"), (2, None, "completed", "2023-01-06 10:00:00"),
         (3, None, "completed", "2023-02-06 10:00:00"), (4, 7, "completed", "2023-02-07 10:00:00")],
        "order_id bigint, customer_id bigint, status string, at string").withColumn("ordered_at", F.col("at").cast("timestamp_ntz"))
    shop = SimpleNamespace(orders=orders)
    assert [tuple(r) for r in cohort.cohort_size(shop).collect()] == [("2023-01", 1)]
    assert [tuple(r)[:4] for r in cohort.cohort_retention_export(shop).collect()] == [("2023-01", 1, 0, 1), ("2023-01", 1, 1, 1)]
    assert cohort.first_purchase(shop).count() == 2


def test_appended_files_are_seen(spark, tmp_path):
    src = "/root/testdata/sf0.001"
    for t in "region nation customer supplier part orders lineitem events".split():
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    count = lambda: {r.table: r.rows for r in E.queries()["table_counts"](spark, str(tmp_path)).collect()}["orders"]
    n = count()
    spark.read.parquet(f"{src}/orders.parquet").write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    assert count() == 2 * n
