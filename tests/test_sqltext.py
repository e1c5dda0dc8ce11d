"""SQL text with named parameters."""

from __future__ import annotations

import datetime as dt

import pytest

from tillroll.plans import sqltext
from tillroll.sources.tables import star_tables

SF = "/root/testdata/sf0.001"


def test_parameters_are_values(spark):
    shop = star_tables(spark, SF)
    text = "SELECT count(*) AS n FROM shop_orders WHERE status = :status"
    done = sqltext.sql_frame(shop, text, {"status": "completed"}).first().n
    assert done == shop.orders.where("status = 'completed'").count() > 0
    assert sqltext.sql_frame(shop, text, {"status": "x' OR '1' = '1"}).first().n == 0
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        sqltext.sql_frame(shop, text)


def test_no_view_stays(spark):
    shop = star_tables(spark, SF)
    before = {t.name for t in spark.catalog.listTables()}
    df = sqltext.sql_frame(shop, "SELECT order_id FROM shop_sales_lines")
    assert {t.name for t in spark.catalog.listTables()} == before
    assert df.count() > 0                                         # the frame outlives its views
    with pytest.raises(Exception):
        sqltext.sql_frame(shop, "SELECT nothing FROM shop_orders")
    assert {t.name for t in spark.catalog.listTables()} == before


def test_snapshot_or_scalar_subquery(spark):
    shop = star_tables(spark, SF)
    last = shop.orders.where("status = 'completed'").selectExpr("max(to_date(ordered_at)) AS d").first().d
    by_query = sqltext.customer_metrics(shop, "completed")
    by_value = sqltext.customer_metrics(shop, "completed", last)
    assert sorted(map(tuple, by_query.collect())) == sorted(map(tuple, by_value.collect()))
    early = sqltext.customer_metrics(shop, "completed", dt.date(1996, 1, 1))
    assert 0 < early.count() < by_query.count() and early.where("recency_days < 0").isEmpty()
