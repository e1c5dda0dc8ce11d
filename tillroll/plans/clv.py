"""Report 7: customer lifetime value by segment.

Kept from the reference: ``clv_index`` is each segment's share of the *sum of
averages* (S12); the prediction is avg(aov) * avg(orders) / (avg(lifespan) /
365), NULL when every lifespan is 0 (S13), rounded once; the other averages
are rounded per column.

``avg_order_value`` averages per-customer ratios spend / orders, which have no
exact decimal form: they are averaged as doubles and rounded with a nudge off ties
(``round_near``). The prediction is a quotient of three averages, also in
doubles, so no product of sums can overflow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.dates import iso_date
from tillroll.functions.numeric import round_div, round_div_decimal, round_money, round_near, to_double
from tillroll.plans.customers import customer_orders, lifespan, with_attributes
from tillroll.sources.tables import Shop


def customer_clv_exact(shop: Shop) -> DataFrame:
    per_customer = with_attributes(customer_orders(shop), shop,
                                   "segment", "city", "referral_src", "acquired_at")
    return per_customer.withColumn("customer_lifespan_days", lifespan())


def customer_clv(shop: Shop) -> DataFrame:
    c = customer_clv_exact(shop)
    return c.select(
        "customer_id", "segment", "city", "referral_src",
        iso_date(F.col("acquired_at")).alias("acquired_at"),
        "order_count", to_double(F.col("total_spend")).alias("total_spend"),
        iso_date(F.col("first_order")).alias("first_order"),
        iso_date(F.col("last_order")).alias("last_order"),
        "customer_lifespan_days",
    )


def _segment_exact(shop: Shop) -> DataFrame:
    c = customer_clv_exact(shop)
    g = c.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("total_spend").alias("_spend"),
        F.sum("order_count").alias("_orders"),
        F.avg(F.col("total_spend").cast("double") / F.col("order_count")).alias("_ratio"),
        F.sum("customer_lifespan_days").alias("_life"),
        F.max("total_spend").alias("_max"),
        F.min("total_spend").alias("_min"),
    )
    avg_clv_dec = F.col("_spend")  # rounded below
    return g.select(
        "segment", "customers",
        round_div(avg_clv_dec, F.col("customers"), 2, num_scale=2).alias("avg_clv"),
        round_div(F.col("_orders"), F.col("customers"), 1).alias("avg_orders"),
        round_near(F.col("_ratio"), 2).alias("avg_order_value"),
        round_div(F.col("_life"), F.col("customers"), 0).alias("avg_lifespan_days"),
        round_money(F.col("_max")).alias("max_clv"),
        round_money(F.col("_min")).alias("min_clv"),
        round_near(F.col("_ratio") * (F.col("_orders") / F.col("customers"))
                   / F.nullif(F.col("_life") / F.col("customers") / F.lit(365.0), F.lit(0.0)), 2)
        .alias("predicted_annual_clv"),
        F.round(F.col("_spend"), 2).alias("total_revenue"),
        # the same rounded avg_clv as an exact decimal, for the index
        round_div_decimal(avg_clv_dec, F.col("customers"), 2, num_scale=2).alias("_avg_clv_dec"),
    )


def segment_clv(shop: Shop) -> DataFrame:
    s = _segment_exact(shop)
    total = F.sum("_avg_clv_dec").over(Window.partitionBy(F.lit(1)))
    return s.select(
        "segment", "customers", "avg_clv", "avg_orders", "avg_order_value", "avg_lifespan_days",
        "max_clv", "min_clv", "predicted_annual_clv",
        round_div(F.col("_avg_clv_dec"), total, 1, factor=100, num_scale=2, den_scale=2).alias("clv_index"),
    ).orderBy(F.col("avg_clv").desc_nulls_last())


def segment_clv_export(shop: Shop) -> DataFrame:
    s = _segment_exact(shop)
    return s.select(
        "segment", "customers", "avg_clv", "avg_orders",
        to_double(F.col("total_revenue")).alias("total_revenue"),
    ).orderBy(F.col("avg_clv").desc_nulls_last())
