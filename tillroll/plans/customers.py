"""Customer grain shared by RFM, marketing ROI and CLV.

Aggregates completed orders per ``customer_id`` first (partial aggregation
absorbs a hot customer map-side), then joins the customer attributes: the
reference groups by the attributes too, but the id decides them, so grouping
by the id alone gives the same groups with a narrower shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import day, days_between
from tillroll.operators.facts import COMPLETED, order_totals
from tillroll.sources.tables import Shop


def customer_orders(shop: Shop) -> DataFrame:
    """customer_id, order_count, total_spend (decimal, 2 dp), first_order, last_order (dates)."""
    ot = order_totals(shop, COMPLETED)
    return ot.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.round(F.sum("revenue"), 2).alias("total_spend"),
        F.min(day(F.col("ordered_at"))).alias("first_order"),
        F.max(day(F.col("ordered_at"))).alias("last_order"),
    )


def with_attributes(per_customer: DataFrame, shop: Shop, *cols: str) -> DataFrame:
    attrs = shop.customers.select("customer_id", *cols)
    return per_customer.join(attrs, "customer_id")


def snapshot(shop: Shop) -> DataFrame:
    """One row: the last completed order date (orders only, lines or not)."""
    return (shop.orders.where(F.col("status") == COMPLETED)
            .agg(F.max(day(F.col("ordered_at"))).alias("snapshot_date")))


def lifespan(first: str = "first_order", last: str = "last_order"):
    return days_between(F.col(last), F.col(first))
