"""Months as partitions: one is replaced and reported, with only its files read."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tillroll.operators.facts import order_totals
from tillroll.plans import channel, revenue
from tillroll.sources import monthly as M
from tillroll.sources.tables import star_tables

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.fixture(scope="module")
def shop(spark):
    return star_tables(spark, SF)


def test_all_months(spark, shop, tmp_path):
    stored = M.write_months(shop, str(tmp_path / "m"))
    assert rows(revenue.monthly_growth(stored)) == rows(revenue.monthly_growth(shop))
    assert rows(channel.channel_quality(stored)) == rows(channel.channel_quality(shop))
    assert rows(order_totals(stored).drop("month")) == rows(order_totals(shop))


def test_one_month_replaced(spark, shop, tmp_path):
    path = str(tmp_path / "m")
    M.write_months(shop, path)
    months = sorted(d[len("month="):] for d in os.listdir(path) if d.startswith("month="))
    one = months[len(months) // 2]
    changed = replace(shop, orders=shop.orders.withColumn(
        "status", F.when(F.date_format("ordered_at", "yyyy-MM") == one, F.lit("completed")).otherwise(F.col("status"))))
    before = files(path)
    M.replace_months(changed, path, [one])
    after = files(path)
    same = {f for f in before if f"month={one}" not in f}
    assert all(before[f] == after[f] for f in same) and {f for f in after if f"month={one}" not in f} == same
    whole = M.open_months(changed, path)
    assert rows(revenue.monthly_revenue(whole)) == rows(revenue.monthly_revenue(changed))
    # the report of that month reads its folder only
    part = M.open_months(changed, path, [one])
    report = revenue.monthly_revenue(part)
    assert rows(report) == rows(revenue.monthly_revenue(changed).where(F.col("month") == one))
    read = {r.f for r in order_totals(part).select(F.input_file_name().alias("f")).distinct().collect()}
    assert read and all(f"month={one}" in f for f in read)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and f"(month#" in plan


def test_recomputing_a_month_reads_orders_of_its_time(spark, shop):
    grain = M._of_months(shop, ["1995-03"])
    plan = spark._jvm.PythonSQLUtils.explainString(grain._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(o_orderdate,1995-03-01T00:00), LessThan(o_orderdate,1995-04-01T00:00)" in plan


def test_a_month_that_loses_its_orders(spark, shop, tmp_path):
    path = str(tmp_path / "m")
    M.write_months(shop, path)
    months = sorted(d[len("month="):] for d in os.listdir(path) if d.startswith("month="))
    less = replace(shop, orders=shop.orders.where(F.date_format("ordered_at", "yyyy-MM") != months[0]))
    M.replace_months(less, path, [months[0], "2050-01"])
    assert rows(order_totals(M.open_months(less, path)).drop("month")) == rows(order_totals(less))
