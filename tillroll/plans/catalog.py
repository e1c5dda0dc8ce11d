"""Registry: query key -> callable ``(spark, sf_dir) -> DataFrame``.

Most keys are functions of a :class:`Shop` (the driver's tables seen through
the adapter); the sink keys write a report and read it back, and those of
``plans/stored.py`` store data in one of the layouts and read that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import iso_datetime
from tillroll.functions.numeric import to_double
from tillroll.operators import facts, quality, rules, shape
from tillroll.plans import channel, clv, cohort, marketing, product, revenue, rfm, stored
from tillroll.session import delete_on_exit, ensure_checkpoint_dir
from tillroll.sources import schema as S
from tillroll.sources import sinks
from tillroll.sources.tables import Shop, star_tables

ShopReport = Callable[[Shop], DataFrame]
Query = Callable[[SparkSession, str], DataFrame]


# --- post-processing of the export reports ----------------------------------

def cohort_matrix(shop: Shop) -> DataFrame:
    return shape.cohort_matrix(cohort.cohort_retention_export(shop), range(0, 6), "retention_pct")


def top_products(shop: Shop) -> DataFrame:
    return shape.top_products(product.product_performance_export(shop))


def paid_channels(shop: Shop) -> DataFrame:
    return shape.paid_channels(marketing.marketing_roi_export(shop))


def return_flags(shop: Shop) -> DataFrame:
    return shape.return_flags(channel.channel_performance_export(shop))


def kpi_summary(shop: Shop) -> DataFrame:
    return shape.kpi_summary(revenue.revenue_trend_export(shop),
                             product.product_performance_export(shop),
                             channel.channel_performance_export(shop))


def display_labels(shop: Shop) -> DataFrame:
    return shape.display_labels(kpi_summary(shop))


def report_stats(shop: Shop) -> DataFrame:
    return shape.report_stats(
        revenue.revenue_trend_export(shop), rfm.rfm_segments_export(shop),
        cohort.cohort_retention_export(shop), product.product_performance_export(shop),
        channel.channel_performance_export(shop), marketing.marketing_roi_export(shop),
        clv.segment_clv_export(shop))


# --- facts and data quality ---------------------------------------------------

def sales_lines(shop: Shop) -> DataFrame:
    """The wide line fact with SQLite-style datetime text and DOUBLE money."""
    s = facts.sales_lines(shop)
    money = ("unit_price", "line_revenue", "line_cost", "net_line_revenue", "line_profit")
    return s.select(
        "order_id", "item_id", "customer_id", "status", "channel",
        iso_datetime(F.col("ordered_at")).alias("ordered_at"),
        iso_datetime(F.col("shipped_at")).alias("shipped_at"),
        to_double(F.col("discount_pct")).alias("discount_pct"),
        "product_id", "quantity",
        *[to_double(F.col(c)).alias(c) for c in money],
    )


def _adapter_rule(table, kind, cols, arg):
    """The adapter has no item id of its own: (order_id, line number) keys a line,
    (month, channel) keys spend, and cost is kept per line."""
    if (table, kind) == ("order_items", "pk"):
        return table, kind, ("order_id", "item_id"), arg
    if (table, kind) == ("marketing_spend", "pk"):
        return table, kind, ("month", "channel"), arg
    if (table, kind) == ("order_items", "not_null"):
        return table, kind, tuple("line_cost" if c == "unit_cost" else c for c in cols), arg
    return table, kind, cols, arg


ADAPTER_RULES = [_adapter_rule(*r) for r in S.RULES]


def _tables(shop: Shop) -> dict[str, DataFrame]:
    return {n: shop.table(n) for n in S.TABLES}


def table_counts(shop: Shop) -> DataFrame:
    return quality.table_counts(_tables(shop))


def constraint_violations(shop: Shop) -> DataFrame:
    return quality.constraint_violations(_tables(shop), ADAPTER_RULES)


def row_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows behind the counts of ``constraint_violations``."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    return stored.row_violations(star_tables(spark, sf_dir, rules.parts(spark, lines)), ADAPTER_RULES)


def apply_defaults(shop: Shop) -> DataFrame:
    """Orders of the adapter (no discount column) with the declared default filled in."""
    o = quality.apply_defaults(shop.orders, "orders")
    return o.select("order_id", "customer_id", "status", "channel",
                    iso_datetime(F.col("ordered_at")).alias("ordered_at"),
                    to_double(F.col("discount_pct")).alias("discount_pct"))


REPORTS: dict[str, ShopReport] = {
    "revenue_trend": revenue.revenue_trend,
    "revenue_trend_export": revenue.revenue_trend_export,
    "monthly_revenue": revenue.monthly_revenue,
    "monthly_growth": revenue.monthly_growth,
    "rfm_segments": rfm.rfm_segments,
    "rfm_segments_five_is_best": rfm.rfm_segments_five_is_best,
    "rfm_segments_export": rfm.rfm_segments_export,
    "snapshot_date": rfm.snapshot_date,
    "customer_rfm_metrics": rfm.customer_rfm_metrics,
    "customer_rfm_scores": rfm.customer_rfm_scores,
    "customer_rfm_labels": rfm.customer_rfm_labels,
    "cohort_retention": cohort.cohort_retention,
    "cohort_retention_export": cohort.cohort_retention_export,
    "first_purchase": cohort.first_purchase,
    "customer_month_index": cohort.customer_month_index,
    "cohort_size": cohort.cohort_size,
    "product_pareto": product.product_pareto,
    "product_performance_export": product.product_performance_export,
    "product_revenue": product.product_revenue,
    "channel_quality": channel.channel_quality,
    "channel_performance_export": channel.channel_performance_export,
    "marketing_roi": marketing.marketing_roi,
    "marketing_roi_export": marketing.marketing_roi_export,
    "channel_revenue": marketing.channel_revenue,
    "channel_spend": marketing.channel_spend,
    "segment_clv": clv.segment_clv,
    "segment_clv_export": clv.segment_clv_export,
    "customer_clv": clv.customer_clv,
    "cohort_matrix": cohort_matrix,
    "top_products": top_products,
    "paid_channels": paid_channels,
    "return_flags": return_flags,
    "kpi_summary": kpi_summary,
    "display_labels": display_labels,
    "report_stats": report_stats,
    "sales_lines": sales_lines,
    "table_counts": table_counts,
    "constraint_violations": constraint_violations,
    "apply_defaults": apply_defaults,
    "defaults_by_table": stored.defaults_by_table,
    "order_grain_bucketed": stored.order_grain_bucketed,
    "export_all": stored.export_all,
    "unique_customers": stored.unique_customers,
    "order_gaps": stored.order_gaps,
    "month_replaced": stored.month_replaced,
    "sql_customer_metrics": stored.sql_customer_metrics,
    "sql_customer_metrics_latest": stored.sql_customer_metrics_latest,
}


def register(name: str, fn: ShopReport) -> None:
    REPORTS[name] = fn


# --- callables over the driver's tables ----------------------------------------

def _prepare(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark, scratch_if_unset=True)


def shop_query(fn: ShopReport) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prepare(spark)
        return fn(star_tables(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _roundtrip(kind: str, report: ShopReport) -> Query:
    """Write a report with a sink (under the shared folder) and read it back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prepare(spark)
        df = report(star_tables(spark, sf_dir))
        path = sinks.shared_path(spark, kind)
        delete_on_exit(spark, path)
        if kind == "csv":
            sinks.export_csv(df, path)
            return sinks.import_csv(spark, path, df.schema)
        if kind == "json":
            sinks.export_json(df, path)
            return sinks.import_json(spark, path, df.schema)
        # a table of this call's own; its files outlive the dropped name until the application ends
        table = f"tillroll_{report.__name__}_{uuid.uuid4().hex[:12]}"
        out = sinks.load_warehouse_table(df, table, path)
        spark.sql(f"DROP TABLE {table}")
        return out
    return run


def _prepared(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _prepare(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


# Keys whose callable needs more than a Shop.
EXTRA: dict[str, Query] = {
    "export_csv": _roundtrip("csv", revenue.revenue_trend_export),
    "import_csv": _roundtrip("csv", clv.segment_clv_export),
    "export_json": _roundtrip("json", kpi_summary),
    "import_json": _roundtrip("json", marketing.marketing_roi_export),
    "load_warehouse_table": _roundtrip("table", channel.channel_performance_export),
    "checked_append": _prepared(stored.checked_append),
    "row_violations": _prepared(row_violations),
    "csv_quarantine": _prepared(stored.csv_quarantine),
}


def all_queries() -> dict[str, Query]:
    """Every registered key as ``(spark, sf_dir) -> DataFrame`` over the driver's tables."""
    out = {k: shop_query(f) for k, f in REPORTS.items()}
    out.update(EXTRA)
    return out
