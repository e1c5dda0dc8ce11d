"""Bucketed facts: the same order grain without an Exchange above the scans; a shared grain for the exports."""

from __future__ import annotations

import glob
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators.facts import join_totals, line_totals, order_totals, with_order_grain
from tillroll.plans import channel, clv, exports, marketing, revenue, rfm
from tillroll.sources import bucketed as B
from tillroll.sources.tables import Shop, shop_from_tables, star_tables

SF = "/root/testdata/sf0.001"


def rows(df):
    return Counter(map(tuple, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    made = []

    def write(shop, buckets):
        made.append(B.write_bucketed(shop, buckets, path=str(tmp_path / f"facts{len(made)}")))
        return made[-1]

    yield write
    for f in made:
        f.drop()


def test_same_order_grain(spark, stored):
    shop = star_tables(spark, SF)
    facts = stored(shop, 5)
    again = B.open_bucketed(spark, facts.name)
    assert again.buckets == 5
    for status in (None, "completed", "pending"):
        got = B.bucketed_order_totals(again, status)
        want = order_totals(shop, status)
        assert got.columns == want.columns and rows(got) == rows(want)


def test_no_exchange_above_the_bucketed_scans(spark, stored):
    facts = stored(star_tables(spark, SF), 4)
    regular = join_totals(line_totals(facts.lines), facts.orders, facts.lines.columns, hint="merge")
    text = plan(regular)
    assert "Exchange" not in text and text.count("Bucketed: true") == 2
    counted = regular.groupBy("order_id").count()               # a grouping by the same key moves nothing either
    assert "Exchange" not in plan(counted)
    whole = plan(B.bucketed_order_totals(facts))
    moved = re.findall(r"Exchange (\w+)", whole)
    assert "SinglePartition" not in moved and whole.count("hashpartitioning(order_id") <= 1   # of heavy orders' sums only
    assert len(glob.glob(f"{spark.sql(f'DESCRIBE EXTENDED {facts.name}_lines').where('col_name = \"Location\"').first().data_type[5:]}/*.parquet")) <= 4


def test_reports_over_the_buckets(spark, stored):
    shop = star_tables(spark, SF)
    over = B.shop_over_buckets(shop, stored(shop, 4))
    for report in (revenue.revenue_trend, channel.channel_quality, clv.segment_clv):
        df = report(over)
        assert rows(df) == rows(report(shop)), report.__name__
        text = plan(df)
        assert "lineitem.parquet" not in text and text.count("hashpartitioning(order_id") <= 1     # heavy orders' sums
    done = plan(revenue.revenue_trend(over))
    assert "EqualTo(status,completed)" in spark._jvm.PythonSQLUtils.explainString(
        revenue.revenue_trend(over)._jdf.queryExecution(), "formatted") and "Bucketed: true" in done


def native(spark, line_rows, order_rows):
    from tillroll.sources import schema as S
    items = spark.createDataFrame(line_rows, "item_id bigint, order_id bigint, product_id bigint, quantity int, "
                                             "unit_price decimal(18,2), unit_cost decimal(18,2)")
    orders = spark.createDataFrame(order_rows, "order_id bigint, customer_id bigint, status string, channel string, "
                                               "ordered_at timestamp_ntz, shipped_at timestamp_ntz, discount_pct decimal(9,4)")
    empty = {n: spark.createDataFrame([], st) for n, st in S.TABLES.items()}
    return shop_from_tables({**empty, "order_items": items, "orders": orders})


def test_hot_null_and_missing_orders(spark, stored):
    import datetime as dt
    from decimal import Decimal as D
    at = dt.datetime(2024, 1, 1)
    orders = [(i, i % 7, "completed", "web", at, at + dt.timedelta(hours=i), D("0.1")) for i in range(40)] + [(None, 1, "completed", "web", at, at, D(0))]
    lines = [(i, 3 if i % 3 == 0 else None if i % 5 == 0 else i % 60, i % 9, 1 + i % 3, D("10.50"), D("4.25")) for i in range(3000)]
    shop = native(spark, lines, orders)
    facts = stored(shop, 6)
    assert [r.order_id for r in B.heavy_orders(shop.lines, 6).collect()] == [3]
    assert rows(B.bucketed_order_totals(facts)) == rows(order_totals(shop))
    assert facts.lines.count() + facts.heavy_lines.count() == 3000          # every line is kept
    assert facts.lines.where("order_id = 3 OR order_id IS NULL").isEmpty()
    empty = stored(native(spark, [], []), 3)
    assert B.bucketed_order_totals(empty).count() == 0


def test_reports_over_a_written_order_grain(spark, tmp_path):
    shop = star_tables(spark, SF)
    grain = with_order_grain(shop, str(tmp_path / "grain"))
    for report in (revenue.revenue_trend, channel.channel_quality, clv.segment_clv, marketing.marketing_roi, rfm.rfm_segments):
        df = report(grain)
        assert rows(df) == rows(report(shop))
        assert "lineitem.parquet" not in plan(df), report.__name__


def test_exports_scan_lines_once_for_the_order_grain(spark, tmp_path, monkeypatch):
    """The same files as report by report, and no written report reads lines (products are checkpointed before)."""
    shop = star_tables(spark, SF)
    scans = []
    write = exports.sinks.export_csv
    monkeypatch.setattr(exports.sinks, "export_csv", lambda df, path: (scans.append("lineitem.parquet" in plan(df)), write(df, path)))
    exports.export_all(shop, str(tmp_path / "shared"))
    assert len(scans) == len(exports.EXPORTS) and not any(scans)
    assert plan(order_totals(shop)).count("lineitem.parquet") == 1       # what the shared grain is written from
    assert not glob.glob(str(tmp_path / "shared" / "_order_grain"))
    for name, report in exports.EXPORTS.items():
        write(report(shop), str(tmp_path / "alone" / name))

        def text(where):
            return sorted(x for f in glob.glob(str(tmp_path / where / name / "*.csv")) for x in open(f))
        assert text("shared") == text("alone"), name
