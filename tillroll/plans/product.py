"""Report 4: product revenue ranking with cumulative share (Pareto).

The rank, running total and grand total run over *all products*, so they use
:mod:`tillroll.operators.ordering` instead of an unpartitioned window. The
running total is ordered by revenue, then ``product_id`` (SURVEY S3: the
reference's frame has no tie-break).

The export groups by product *name* and category, not id; two ids with the
same name form one row and their orders are counted once per order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numeric import round_div, round_money, to_double
from tillroll.operators.facts import COMPLETED, order_product_totals
from tillroll.operators.ordering import global_order
from tillroll.sources.tables import Shop


def _named_products(shop: Shop) -> DataFrame:
    """product_id, product_name, category (inner joins, as the reference)."""
    cat = shop.categories.select("category_id", F.col("name").alias("category"))
    return (shop.products.select("product_id", F.col("name").alias("product_name"), "category_id")
            .join(cat, "category_id").drop("category_id"))


def product_numbers(shop: Shop) -> DataFrame:
    """Per product with a name and category: its counts and sums, without them."""
    pairs = order_product_totals(shop, COMPLETED)
    per_product = pairs.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("orders_count"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").alias("_rev"),
        F.sum("profit").alias("_profit"),
        F.sum("price_sum").alias("_price_sum"),
        F.sum("price_n").alias("_price_n"),
    )
    return per_product.join(_named_products(shop), "product_id", "left_semi").select(
        "product_id", "orders_count", "units_sold",
        F.round(F.col("_rev"), 2).alias("total_revenue"),
        F.round(F.col("_profit"), 2).alias("total_profit"),
        round_div(F.col("_price_sum"), F.col("_price_n"), 2, num_scale=2).alias("avg_selling_price"),
        round_div(F.col("_profit"), F.col("_rev"), 1, factor=100, num_scale=2, den_scale=2)
        .alias("margin_pct"),
    )


def product_revenue_exact(shop: Shop) -> DataFrame:
    return product_numbers(shop).join(_named_products(shop), "product_id")


def product_revenue(shop: Shop) -> DataFrame:
    p = product_revenue_exact(shop)
    return p.select(
        "product_id", "product_name", "category", "orders_count", "units_sold",
        to_double(F.col("total_revenue")).alias("total_revenue"),
        to_double(F.col("total_profit")).alias("total_profit"),
        "avg_selling_price", "margin_pct",
    )


def product_pareto(shop: Shop, buckets: int | None = None) -> DataFrame:
    ranked = global_order(product_numbers(shop), "total_revenue", descending=True, tiebreak="product_id",
                          sum_col="total_revenue", buckets=buckets)
    return ranked.join(_named_products(shop), "product_id").select(
        F.col("rank").cast("bigint").alias("revenue_rank"),
        "product_name", "category", "orders_count", "units_sold",
        to_double(F.col("total_revenue")).alias("total_revenue"),
        to_double(F.col("total_profit")).alias("total_profit"),
        "margin_pct",
        round_div(F.col("running_sum"), F.col("grand_total"), 1, factor=100,
                  num_scale=2, den_scale=2).alias("cumulative_revenue_pct"),
    ).orderBy("revenue_rank", "total_revenue")


def product_performance_export(shop: Shop, buckets: int | None = None) -> DataFrame:
    pairs = order_product_totals(shop, COMPLETED).join(_named_products(shop), "product_id")
    g = pairs.groupBy(F.col("product_name").alias("product"), "category").agg(
        F.countDistinct("order_id").alias("orders"),
        F.sum("units").alias("units"),
        F.sum("revenue").alias("_rev"),
        F.sum("profit").alias("_profit"),
    ).select(
        "product", "category", "orders", "units",
        F.round(F.col("_rev"), 2).alias("revenue"),
        round_money(F.col("_profit")).alias("profit"),
        round_div(F.col("_profit"), F.col("_rev"), 1, factor=100, num_scale=2, den_scale=2)
        .alias("margin_pct"),
    )
    ranked = global_order(g, "revenue", descending=True, buckets=buckets)
    return ranked.select(
        "product", "category", "orders", "units",
        to_double(F.col("revenue")).alias("revenue"), "profit", "margin_pct",
        F.col("rank").cast("bigint").alias("rank"),
    ).orderBy(F.col("revenue").desc_nulls_last())
