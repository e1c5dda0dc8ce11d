"""Hand-checked cases in the native schema, one per semantic note of the survey."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import types as T

from tillroll.operators.quality import apply_defaults, constraint_violations, table_counts
from tillroll.plans import channel, clv, cohort, marketing, product, revenue, rfm
from tillroll.sources import schema as S
from tillroll.sources.tables import shop_from_tables


def _nullable(st: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in st.fields])


def ts(s):
    return dt.datetime.fromisoformat(s)


CATEGORIES = [(1, "Electronics", None), (6, "Phones", 1), (7, "Audio", 1)]
PRODUCTS = [  # two ids share a name; product 3 has no category
    (1, "Widget", 6, D("60.00"), D("100.00"), dt.date(2022, 1, 1), 1),
    (2, "Widget", 6, D("30.00"), D("50.00"), dt.date(2022, 1, 1), 1),
    (3, "Gizmo", None, D("25.00"), D("20.00"), dt.date(2022, 1, 1), 1),
    (4, "Free", 7, D("0.00"), D("0.00"), dt.date(2022, 1, 1), 1),
]
CUSTOMERS = [
    (1, "Alice A", "a@x", "Durban", "ZA", "B2C", dt.date(2022, 1, 1), "google"),
    (2, "Bob B", "b@x", "Durban", "ZA", "B2B", dt.date(2022, 1, 1), "organic"),
    (3, "Cara C", "c@x", "Pretoria", "ZA", "VIP", dt.date(2022, 1, 1), None),
    (4, "Dan D", "d@x", "Pretoria", "ZA", "B2C", dt.date(2022, 1, 1), "google"),
    (5, "Eve E", "e@x", "Durban", "ZA", "VIP", dt.date(2022, 1, 1), "email"),
]
ORDERS = [
    (10, 1, "completed", "web", ts("2022-01-15 10:00:00"), ts("2022-01-17 10:00:00"), D("0.10")),
    (11, 1, "completed", "web", ts("2022-03-10 09:00:00"), None, D("0")),
    (12, 2, "completed", "mobile", ts("2022-12-20 09:00:00"), ts("2022-12-21 09:00:00"), D("0")),
    (13, 2, "completed", "mobile", ts("2023-01-05 09:00:00"), None, D("0")),
    (14, 3, "completed", "store", ts("2022-01-20 09:00:00"), None, D("0")),      # no lines
    (15, 4, "returned", "web", ts("2022-01-21 09:00:00"), None, D("0")),
    (16, 3, "completed", "store", ts("2022-02-01 09:00:00"), None, D("0")),
    (17, 1, "completed", "web", ts("2022-08-20 09:00:00"), None, D("0")),
    (18, 5, "completed", "marketplace", ts("2022-05-05 09:00:00"), None, D("0")),  # no lines
    (19, 4, "cancelled", "marketplace", ts("2022-06-01 09:00:00"), None, D("0")),
]
ITEMS = [
    (100, 10, 1, 1, D("100.00"), D("60.00")),
    (101, 11, 2, 2, D("50.00"), D("30.00")),
    (102, 11, 1, 1, D("80.00"), D("50.00")),
    (103, 11, 3, 1, D("20.00"), D("25.00")),
    (104, 12, 2, 3, D("40.00"), D("10.00")),
    (105, 13, 1, 1, D("100.00"), D("60.00")),
    (106, 15, 1, 1, D("100.00"), D("60.00")),
    (107, 16, 4, 1, D("0.00"), D("0.00")),
    (108, 17, 1, 1, D("70.00"), D("40.00")),
    (109, 19, 1, 1, D("90.00"), D("50.00")),
]
SPEND = [(1, "2022-01", "google", D("500.00")), (2, "2022-02", "google", D("500.00")),
         (3, "2022-01", "tiktok", D("300.00")), (4, "2022-01", "email", D("200.00"))]


def _tables(spark, **override):
    data = {"categories": CATEGORIES, "products": PRODUCTS, "customers": CUSTOMERS,
            "orders": ORDERS, "order_items": ITEMS, "marketing_spend": SPEND}
    data.update(override)
    return {n: spark.createDataFrame(rows, _nullable(S.TABLES[n])) for n, rows in data.items()}


@pytest.fixture(scope="module")
def shop(spark):
    return shop_from_tables(_tables(spark))


def _by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_revenue_growth_rules(shop):
    t = _by(revenue.revenue_trend(shop), "month")
    assert list(t) == sorted(t)
    assert set(t) == {"2022-01", "2022-02", "2022-03", "2022-08", "2022-12", "2023-01"}
    assert t["2022-01"]["mom_growth"] == "N/A"                 # first month
    assert t["2022-01"]["net_revenue"] == 90.0                  # S4: discount applied on the line
    assert t["2022-02"]["profit_margin_pct"] is None            # revenue 0 -> NULLIF
    assert t["2022-03"]["mom_growth"] == "N/A"                  # previous month revenue 0
    assert t["2022-08"]["mom_growth"] == "-65.0%"               # S9: compares with March
    assert t["2022-01"]["total_orders"] == 1                    # order without lines not counted


def test_cohorts(shop):
    rows = cohort.cohort_retention(shop).collect()
    got = {(r.cohort_month, r.month_number): (r.cohort_customers, r.retained_customers,
                                               r.retention_rate_pct) for r in rows}
    assert got[("2022-01", 0)] == (2, 2, 100.0)     # c3 counted through an order without lines (S8)
    assert got[("2022-01", 1)] == (2, 1, 50.0)
    assert got[("2022-01", 2)] == (2, 1, 50.0)
    assert ("2022-01", 7) not in got                # month 7 outside 0..6
    assert got[("2022-12", 1)] == (1, 1, 100.0)     # year boundary
    assert got[("2022-05", 0)] == (1, 1, 100.0)     # customer whose only order has no lines
    assert all(v[2] == 100.0 for k, v in got.items() if k[1] == 0)
    export = {(r.cohort_month, r.month_number) for r in cohort.cohort_retention_export(shop).collect()}
    assert max(m for _, m in export) <= 5


def test_customer_grain_excludes_non_completed_and_lineless(shop):
    ids = {r.customer_id for r in rfm.customer_rfm_metrics(shop).collect()}
    assert ids == {1, 2, 3}


def test_score_direction_and_small_n(shop):
    written = _by(rfm.customer_rfm_scores(shop), "customer_id")
    flipped = _by(rfm.customer_rfm_scores(shop, "five_is_best"), "customer_id")
    assert sorted(r["r_score"] for r in written.values()) == [1, 2, 3]   # fewer rows than tiles
    best = min(written.values(), key=lambda r: (r["recency_days"], r["customer_id"]))["customer_id"]
    assert written[best]["r_score"] == 1                                # S1: tile 1 is the best
    assert flipped[best]["r_score"] == max(r["r_score"] for r in flipped.values())


def test_labels_exact(spark):
    from pyspark.sql import functions as F
    cases = [((4, 4, 4), 0), ((3, 3, 1), 1), ((4, 2, 1), 2), ((3, 1, 3), 3),
             ((2, 3, 3), 4), ((2, 4, 1), 5), ((1, 2, 5), 6), ((2, 2, 2), 7)]
    df = spark.createDataFrame([c for c, _ in cases], "r int, f int, m int")
    got = df.select(rfm.rfm_label(F.col("r"), F.col("f"), F.col("m")).alias("l")).collect()
    assert [g.l for g in got] == [S.RFM_LABELS_DETAIL[i] for _, i in cases]
    assert S.RFM_LABELS_DETAIL[4] == "⚠️  At Risk"


def test_channels(shop):
    c = _by(channel.channel_quality(shop), "channel")
    web = c["web"]
    assert (web["total_orders"], web["completed"], web["returned"]) == (4, 3, 1)
    assert web["return_rate_pct"] == 25.0
    assert web["avg_order_value"] == 74.0            # S7: average over lines, not orders
    assert web["avg_days_to_ship"] == 2.0            # NULL ship dates left out
    mk = c["marketplace"]
    assert (mk["completed"], mk["net_revenue"], mk["avg_order_value"]) == (0, 0.0, None)
    assert mk["aov_rank"] == max(r["aov_rank"] for r in c.values())


def test_marketing(shop):
    rows = marketing.marketing_roi(shop).collect()
    by = {r.acq_channel: r for r in rows}
    assert set(by) == {"google", "organic", None}     # tiktok spend without customers drops out
    assert by["organic"].revenue_per_rand_spent is None and by["organic"].marketing_spend == 0.0
    assert by[None].marketing_spend == 0.0            # NULL source is its own group
    assert by["google"].roi_rank == 1 and by["organic"].roi_rank == 2 and by[None].roi_rank == 2


def test_clv_prediction_null_when_no_lifespan(shop):
    s = _by(clv.segment_clv(shop), "segment")
    assert s["VIP"]["avg_lifespan_days"] == 0.0
    assert s["VIP"]["predicted_annual_clv"] is None
    assert s["B2B"]["predicted_annual_clv"] is not None


def test_products(shop):
    p = product.product_pareto(shop).collect()
    assert sorted(r.product_name for r in p) == ["Free", "Widget", "Widget"]  # no category: dropped
    assert max(r.cumulative_revenue_pct for r in p) == 100.0
    e = product.product_performance_export(shop).collect()
    assert sorted(r.product for r in e) == ["Free", "Widget"]


def test_empty_tables_keep_schema(spark):
    empty = shop_from_tables(_tables(spark, orders=[], order_items=[]))
    df = revenue.revenue_trend(empty)
    assert df.collect() == []
    assert df.columns[0] == "month"
    assert product.product_pareto(empty).collect() == []
    assert rfm.rfm_segments(empty).collect() == []


def test_constraint_violations(spark):
    bad = _tables(
        spark,
        customers=CUSTOMERS + [(6, None, "a@x", "Durban", "ZA", "X", dt.date(2022, 1, 1), "google")],
        orders=ORDERS + [(10, 99, "completed", "web", ts("2022-01-15 10:00:00"), None, D("0"))],
    )
    v = {(r.table, r.rule, r.columns): r.violations for r in constraint_violations(bad).collect()}
    assert v[("orders", "pk", "order_id")] == 1
    assert v[("customers", "unique", "email")] == 1
    assert v[("customers", "not_null", "full_name")] == 1
    assert v[("customers", "check_in", "segment")] == 1
    assert v[("orders", "fk", "customer_id")] == 1
    assert v[("order_items", "fk", "product_id")] == 0


def test_counts_and_defaults(spark):
    t = _tables(spark)
    counts = {r.table: r.rows for r in table_counts(t).collect()}
    assert counts["orders"] == len(ORDERS) and counts["order_items"] == len(ITEMS)
    o = apply_defaults(t["orders"].drop("discount_pct"), "orders")
    assert {r.discount_pct for r in o.collect()} == {D("0.0000")}
    kept = apply_defaults(t["orders"], "orders")     # a present column is left alone
    assert kept.columns == t["orders"].columns
