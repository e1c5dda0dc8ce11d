"""Report 6: marketing return on spend per acquisition channel.

Spend is summed per channel over all months and is not aligned with order
dates (SURVEY S10); channels with spend but no customers drop out of the left
join. Both sides are aggregated before the join (no fan-out of spend rows),
and the join is between two tables of one row per channel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.numeric import round_div, to_double
from tillroll.plans.customers import customer_orders, with_attributes
from tillroll.sources.tables import Shop


def channel_revenue_exact(shop: Shop) -> DataFrame:
    per_customer = with_attributes(customer_orders(shop), shop, "referral_src")
    return per_customer.groupBy(F.col("referral_src").alias("acq_channel")).agg(
        F.count(F.lit(1)).alias("customers_acquired"),
        F.sum("order_count").alias("total_orders"),
        F.round(F.sum("total_spend"), 2).alias("total_revenue"),
    )


def channel_spend_exact(shop: Shop) -> DataFrame:
    return shop.spend.groupBy("channel").agg(F.round(F.sum("spend_zar"), 2).alias("total_spend"))


def channel_revenue(shop: Shop) -> DataFrame:
    r = channel_revenue_exact(shop)
    return r.select("acq_channel", "customers_acquired", "total_orders",
                    to_double(F.col("total_revenue")).alias("total_revenue"))


def channel_spend(shop: Shop) -> DataFrame:
    s = channel_spend_exact(shop)
    return s.select("channel", to_double(F.col("total_spend")).alias("total_spend"))


def _combined(shop: Shop) -> DataFrame:
    r = channel_revenue_exact(shop)
    s = channel_spend_exact(shop)
    return r.join(s, r.acq_channel == s.channel, "left").select(
        "acq_channel", "customers_acquired", "total_orders", "total_revenue", "total_spend",
        round_div(F.col("total_revenue"), F.col("total_spend"), 2, num_scale=2, den_scale=2)
        .alias("revenue_per_rand_spent"),
        round_div(F.col("total_spend"), F.col("customers_acquired"), 2, num_scale=2)
        .alias("cost_per_customer"),
        round_div(F.col("total_revenue"), F.col("customers_acquired"), 2, num_scale=2)
        .alias("revenue_per_customer"),
    )


def marketing_roi(shop: Shop) -> DataFrame:
    c = _combined(shop)
    roi = F.col("revenue_per_rand_spent").desc_nulls_last()
    return c.select(
        "acq_channel", "customers_acquired", "total_orders",
        to_double(F.col("total_revenue")).alias("total_revenue"),
        to_double(F.coalesce(F.col("total_spend"), F.lit(0))).alias("marketing_spend"),
        "revenue_per_rand_spent", "cost_per_customer", "revenue_per_customer",
        F.rank().over(Window.orderBy(roi)).cast("bigint").alias("roi_rank"),
    ).orderBy(roi)


def marketing_roi_export(shop: Shop) -> DataFrame:
    c = _combined(shop)
    return c.select(
        F.col("acq_channel").alias("channel"),
        F.col("customers_acquired").alias("customers"),
        to_double(F.col("total_revenue")).alias("revenue"),
        to_double(F.coalesce(F.col("total_spend"), F.lit(0))).alias("spend"),
        F.col("revenue_per_rand_spent").alias("roas"),
        F.col("cost_per_customer").alias("cac"),
    ).orderBy(F.col("roas").desc_nulls_last())
