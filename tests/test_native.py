"""The native layout: every report on generated tables, saved, read back in each format, against DuckDB SQL."""

from __future__ import annotations

import pytest

from tests.test_oracle import _rows
from tillroll.plans import channel, clv, cohort, marketing, product, revenue, rfm
from tillroll.plans.oracle import NATIVE, reports
from tillroll.sources.sinks import save_tables
from tillroll.sources.synth import synth_shop, synth_tables
from tillroll.sources.tables import load_shop

# report and the columns its rows are ordered by
REPORTS = {
    "revenue_trend": (revenue.revenue_trend, ["month"]),
    "revenue_trend_export": (revenue.revenue_trend_export, ["month"]),
    "rfm_segments": (rfm.rfm_segments, ["avg_spend"]),
    "rfm_segments_five_is_best": (rfm.rfm_segments_five_is_best, ["avg_spend"]),
    "rfm_segments_export": (rfm.rfm_segments_export, ["avg_spend"]),
    "cohort_retention": (cohort.cohort_retention, ["cohort_month", "month_number"]),
    "cohort_retention_export": (cohort.cohort_retention_export, ["cohort_month", "month_number"]),
    "product_pareto": (product.product_pareto, ["revenue_rank"]),
    "product_performance_export": (product.product_performance_export, ["revenue"]),
    "channel_quality": (channel.channel_quality, ["net_revenue"]),
    "channel_performance_export": (channel.channel_performance_export, ["net_revenue"]),
    "marketing_roi": (marketing.marketing_roi, ["revenue_per_rand_spent"]),
    "marketing_roi_export": (marketing.marketing_roi_export, ["roas"]),
    "segment_clv": (clv.segment_clv, ["avg_clv"]),
    "segment_clv_export": (clv.segment_clv_export, ["avg_clv"]),
}
SQL = reports(NATIVE)


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("native")
    tables = synth_tables(synth_shop(spark, n_customers=400))
    for fmt in ("parquet", "json"):
        save_tables(tables, str(root / fmt), fmt=fmt)
    for name, df in tables.items():
        df.write.option("header", True).csv(str(root / "csv" / name))
    return root


@pytest.fixture(scope="module")
def native_duck(saved):
    import duckdb
    con = duckdb.connect()
    for t in ("categories", "products", "customers", "orders", "order_items", "marketing_spend"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{saved}/parquet/{t}/*.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(REPORTS))
def test_report_matches_sql_on_native_tables(spark, saved, native_duck, key):
    report, order = REPORTS[key]
    df = report(load_shop(spark, str(saved / "parquet")))
    got = [tuple(r) for r in df.collect()]
    cur = native_duck.execute(SQL[key])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(want) > 0
    names = sorted(cols)
    assert _rows(df.columns, got, names) == _rows(cols, want, names)
    pick = lambda names, rows: [tuple(r[names.index(c)] for c in order) for r in rows]
    assert pick(df.columns, got) == pick(cols, want)


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_other_formats_read_the_same(spark, saved, fmt):
    want, got = load_shop(spark, str(saved / "parquet")), load_shop(spark, str(saved / fmt), fmt)
    for name in ("customers", "orders", "order_items", "products", "categories", "marketing_spend"):
        a, b = want.table(name), got.table(name)
        assert a.schema.simpleString() == b.schema.simpleString()
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
    for key in ("channel_quality", "rfm_segments"):
        report = REPORTS[key][0]
        assert [tuple(r) for r in report(want).collect()] == [tuple(r) for r in report(got).collect()]


def test_declared_defaults_fill_missing_columns(spark, saved):
    from tillroll.operators.quality import apply_defaults
    shop = load_shop(spark, str(saved / "parquet"))
    assert {r.country for r in apply_defaults(shop.customers.drop("country"), "customers").select("country").distinct().collect()} == {"ZA"}
    assert {r.is_active for r in apply_defaults(shop.products.drop("is_active"), "products").select("is_active").distinct().collect()} == {1}
    assert {float(r.discount_pct) for r in apply_defaults(shop.orders.drop("discount_pct"), "orders").select("discount_pct").distinct().collect()} == {0.0}


def test_exports_replace_and_carry_a_header(spark, saved, tmp_path):
    from tillroll.sources import sinks
    df = revenue.revenue_trend_export(load_shop(spark, str(saved / "parquet"))).coalesce(1)
    for _ in range(2):
        sinks.export_csv(df, str(tmp_path / "out"))
    text = [p.read_text() for p in (tmp_path / "out").glob("part-*.csv")]
    assert len(text) == 1 and text[0].splitlines()[0] == ",".join(df.columns)
    assert sinks.import_csv(spark, str(tmp_path / "out"), df.schema).count() == df.count()
