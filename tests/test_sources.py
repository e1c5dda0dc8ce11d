"""Sources and sinks: native tables on disk, SQL over views, generator shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.plans import revenue
from tillroll.sources import sinks
from tillroll.sources.synth import synth_shop, synth_tables
from tillroll.sources.tables import load_shop, register_views


def test_save_load_and_sql_views(spark, tmp_path):
    shop = synth_shop(spark, n_customers=200)
    root = str(tmp_path / "shop")
    sinks.save_tables(synth_tables(shop), root)
    native = load_shop(spark, root)
    register_views(native, prefix="t_")
    via_sql = spark.sql("""
        WITH m AS (
            SELECT date_format(ordered_at, 'yyyy-MM') AS month,
                   COUNT(DISTINCT order_id) AS total_orders,
                   ROUND(SUM(net_line_revenue), 2) AS net_revenue
            FROM t_sales_lines WHERE status = 'completed' GROUP BY 1)
        SELECT month, total_orders, CAST(net_revenue AS DOUBLE) AS net_revenue FROM m""")
    df = revenue.revenue_trend_export(native).select("month", "total_orders", "net_revenue")
    assert sorted(map(tuple, via_sql.collect())) == sorted(map(tuple, df.collect()))
    # append is a bulk insert: twice the rows
    sinks.save_tables({"marketing_spend": native.spend}, root, mode="append")
    assert load_shop(spark, root).spend.count() == 2 * 120


def test_generator_shape(spark):
    shop = synth_shop(spark, n_customers=300, seed=42)
    o = shop.orders
    assert o.select("order_id").distinct().count() == o.count()
    assert shop.lines.select("item_id").distinct().count() == shop.lines.count()
    assert shop.spend.count() == 24 * 5
    assert o.where(F.col("ordered_at") > F.lit("2024-01-01").cast("timestamp_ntz")).count() == 0
    assert o.where((F.col("status") != "completed") & F.col("shipped_at").isNotNull()).count() == 0
    per_order = shop.lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"),
                                                   F.countDistinct("product_id").alias("d"))
    assert per_order.where("n <> d OR n > 3").count() == 0     # distinct products, 1-3 lines
    again = synth_shop(spark, n_customers=300, seed=42).orders
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, o.collect()))   # seeded


def test_export_all_writes_every_report(spark, tmp_path):
    from tillroll.plans.exports import EXPORTS, export_all
    from tillroll.sources.tables import star_tables
    from tillroll.plans import revenue as rev
    shop = star_tables(spark, "/root/testdata/sf0.001")
    out = str(tmp_path / "out")
    stats = {(r.report, r.metric): r.value for r in export_all(shop, out).collect()}
    for name in EXPORTS:
        assert spark.read.option("header", True).csv(f"{out}/{name}").count() > 0
    summary = spark.read.json(f"{out}/summary").collect()
    assert len(summary) == 1 and summary[0].total_orders > 0
    months = rev.revenue_trend_export(shop).count()
    assert stats[("revenue_trend", "months")] == str(months)
