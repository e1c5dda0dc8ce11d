"""Report 1: monthly revenue, profit, margin and month-over-month growth.

Notes kept from the reference (SURVEY S4, S5, S9, S14):
- ``net_revenue`` multiplies line revenue by (1 - discount) although the seeded
  unit price is already net of it; the formula is kept as written.
- The margin is profit without discount over revenue with discount.
- Growth compares with the previous *row*: a month with no completed order is
  skipped, not zero.
- Margin and growth are computed from the rounded monthly figures.

The month window runs over one row per month (a bounded, tiny input).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.dates import month_key
from tillroll.functions.numeric import pct_text, round_div, to_double
from tillroll.operators.facts import COMPLETED, order_totals
from tillroll.sources.tables import Shop


def monthly_revenue_exact(shop: Shop) -> DataFrame:
    """Month grain with money still DECIMAL (input to the ratio columns)."""
    ot = order_totals(shop, COMPLETED)
    return ot.groupBy(month_key(F.col("ordered_at")).alias("month")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.round(F.sum("revenue"), 2).alias("gross_revenue"),
        F.round(F.sum("net_revenue"), 2).alias("net_revenue"),
        F.round(F.sum("profit"), 2).alias("gross_profit"),
    )


def _margin(profit: str, revenue: str):
    return round_div(F.col(profit), F.col(revenue), 1, factor=100, num_scale=2, den_scale=2)


def monthly_growth_exact(shop: Shop) -> DataFrame:
    m = monthly_revenue_exact(shop)
    prev = F.lag("net_revenue").over(Window.orderBy("month"))
    return (m.withColumn("prev_month_revenue", prev)
            .withColumn("mom_growth_pct",
                        round_div(F.col("net_revenue") - F.col("prev_month_revenue"),
                                  F.col("prev_month_revenue"), 1, factor=100,
                                  num_scale=2, den_scale=2))
            .withColumn("profit_margin_pct", _margin("gross_profit", "net_revenue")))


def monthly_revenue(shop: Shop) -> DataFrame:
    """month, total_orders, unique_customers, gross_revenue, net_revenue, gross_profit."""
    m = monthly_revenue_exact(shop)
    return m.select("month", "total_orders", "unique_customers",
                    *[to_double(F.col(c)).alias(c) for c in ("gross_revenue", "net_revenue", "gross_profit")])


def monthly_growth(shop: Shop) -> DataFrame:
    """The month grain plus previous month's revenue, growth % and margin %."""
    g = monthly_growth_exact(shop)
    money_cols = ("gross_revenue", "net_revenue", "gross_profit", "prev_month_revenue")
    return g.select("month", "total_orders", "unique_customers",
                    *[to_double(F.col(c)).alias(c) for c in money_cols],
                    "mom_growth_pct", "profit_margin_pct")


def revenue_trend(shop: Shop) -> DataFrame:
    """Detail report: ..., profit_margin_pct, mom_growth text ('12.3%' or 'N/A')."""
    g = monthly_growth_exact(shop)
    return g.select(
        "month", "total_orders", "unique_customers",
        to_double(F.col("net_revenue")).alias("net_revenue"),
        to_double(F.col("gross_profit")).alias("gross_profit"),
        "profit_margin_pct",
        F.coalesce(pct_text(F.col("mom_growth_pct")), F.lit("N/A")).alias("mom_growth"),
    ).orderBy("month")


def revenue_trend_export(shop: Shop) -> DataFrame:
    """Export form: no growth; the margin is named ``margin_pct``."""
    m = monthly_revenue_exact(shop)
    return m.select(
        "month", "total_orders", "unique_customers",
        to_double(F.col("net_revenue")).alias("net_revenue"),
        to_double(F.col("gross_profit")).alias("gross_profit"),
        _margin("gross_profit", "net_revenue").alias("margin_pct"),
    ).orderBy("month")
