"""SQL text as an entry: named parameters over the shop's tables.

``sql_frame`` runs any query text over a shop's tables, seen as ``shop_orders``, ``shop_order_items``,
``shop_customers``, ``shop_products``, ``shop_categories``, ``shop_marketing_spend`` and ``shop_sales_lines``. Values
go in as named parameters (``:status``), never by pasting text. The frame is lazy; the views
are gone when the call returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.sources.tables import Shop, register_views

PREFIX = "shop_"

# Recency, frequency and spend per customer as of :snapshot, or of the last order of :status where :snapshot is NULL.
CUSTOMER_METRICS = """
SELECT customer_id,
       CAST(datediff(coalesce(:snapshot, (SELECT max(to_date(ordered_at)) FROM shop_orders WHERE status = :status)),
                     max(to_date(ordered_at))) AS BIGINT) AS recency_days,
       count(DISTINCT order_id) AS frequency,
       CAST(round(sum(line_revenue), 2) AS DOUBLE) AS monetary
FROM shop_sales_lines
WHERE status = :status AND (:snapshot IS NULL OR to_date(ordered_at) <= :snapshot)
GROUP BY customer_id
"""


def sql_frame(shop: Shop, text: str, args: dict | None = None) -> DataFrame:
    """The result of ``text`` with the named parameters ``args``."""
    spark = shop.orders.sparkSession
    names = register_views(shop, prefix=PREFIX)
    try:
        return spark.sql(text, args=args or {})
    finally:
        for name in names:
            spark.catalog.dropTempView(name)


def customer_metrics(shop: Shop, status: str, snapshot=None) -> DataFrame:
    """customer_id, recency_days, frequency, monetary of the orders of one status up to a date (``datetime.date`` or None)."""
    return sql_frame(shop, CUSTOMER_METRICS, {"status": status, "snapshot": snapshot})
