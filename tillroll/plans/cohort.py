"""Report 3: monthly cohort retention.

Reads ``orders`` only (SURVEY S8): a completed order without lines still
places its customer in a cohort. Month numbers come from year/month
arithmetic (S16), not text subtraction.

Plan: completed orders -> distinct (customer, month) pairs (partial
aggregation: a customer with a third of all orders still yields at most one
row per month) -> cohort = min month per customer over those pairs (a window
per customer over at most #months rows) -> count customers per (cohort,
month number). The cohort size is the month-0 count of the same result, so
no second pass over orders and no join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.dates import month_key, month_of_ordinal, month_ordinal
from tillroll.functions.numeric import round_div
from tillroll.operators.facts import COMPLETED
from tillroll.sources.tables import Shop


def _completed(shop: Shop) -> DataFrame:
    return shop.orders.where(F.col("status") == COMPLETED)


def first_purchase(shop: Shop) -> DataFrame:
    """customer_id, cohort_month ('YYYY-MM' of the first completed order)."""
    return _completed(shop).groupBy("customer_id").agg(
        F.min(month_key(F.col("ordered_at"))).alias("cohort_month"))


def customer_month_index(shop: Shop) -> DataFrame:
    """One row per completed order: customer_id, cohort_month, month_number."""
    fp = first_purchase(shop).withColumn("_cm", F.to_date(F.concat("cohort_month", F.lit("-01"))))
    o = _completed(shop).select("customer_id", "ordered_at")
    return o.join(fp, "customer_id").select(
        "customer_id", "cohort_month",
        (month_ordinal(F.col("ordered_at")) - month_ordinal(F.col("_cm"))).cast("bigint")
        .alias("month_number"))


def cohort_size(shop: Shop) -> DataFrame:
    """cohort_month, cohort_customers."""
    return first_purchase(shop).where("customer_id IS NOT NULL").groupBy("cohort_month").agg(
        F.count(F.lit(1)).alias("cohort_customers"))


def _retention(shop: Shop, max_month: int) -> DataFrame:
    # a guest order (no customer) belongs to no cohort, as in the reference's join
    pairs = (_completed(shop).where("customer_id IS NOT NULL")
             .select("customer_id", month_ordinal(F.col("ordered_at")).alias("m"))
             .distinct())
    first = F.min("m").over(Window.partitionBy("customer_id"))
    indexed = pairs.withColumn("cohort", first).withColumn("month_number", F.col("m") - F.col("cohort"))
    counts = (indexed.where(F.col("month_number").between(0, max_month))
              .groupBy("cohort", "month_number")
              .agg(F.count(F.lit(1)).alias("retained")))
    size = F.max(F.when(F.col("month_number") == 0, F.col("retained"))).over(
        Window.partitionBy("cohort"))
    return counts.select(
        month_of_ordinal(F.col("cohort")).alias("cohort_month"),
        size.alias("cohort_customers"),
        F.col("month_number").cast("bigint").alias("month_number"),
        "retained",
    )


def cohort_retention(shop: Shop, max_month: int = 6) -> DataFrame:
    r = _retention(shop, max_month)
    return r.select(
        "cohort_month", "cohort_customers", "month_number",
        F.col("retained").alias("retained_customers"),
        round_div(F.col("retained"), F.col("cohort_customers"), 1, factor=100).alias("retention_rate_pct"),
    ).orderBy("cohort_month", "month_number")


def cohort_retention_export(shop: Shop, max_month: int = 5) -> DataFrame:
    r = _retention(shop, max_month)
    return r.select(
        "cohort_month", "cohort_customers", "month_number", "retained",
        round_div(F.col("retained"), F.col("cohort_customers"), 1, factor=100).alias("retention_pct"),
    ).orderBy("cohort_month", "month_number")
