"""Fact tables the reports share.

``order_totals`` aggregates lines to order grain *before* joining orders: the
partial aggregate collapses the lines of an order map-side, the join then
moves one row per order, and a hot order can no longer skew the join. Every
report that counts orders works on this grain, so "COUNT(DISTINCT order_id)"
becomes a plain count and only one distinct aggregate (customers) is left per
query (no Expand of the input per distinct set).

Line-weighted averages of the reference (S7) survive the pre-aggregation
because ``n_lines``, ``ship_micros`` and ``ship_lines`` are carried along.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import epoch_micros, micros_between
from tillroll.sources.tables import Shop

COMPLETED = "completed"
MICROS = "decimal(28,0)"   # sums of microseconds, which outgrow BIGINT; a sum of these is DECIMAL(38,0)


def _per_line(shop: Shop, name: str) -> bool:
    return name in shop.lines.columns


def _orders(shop: Shop, status: str | None) -> DataFrame:
    o = shop.orders
    return o if status is None else o.where(F.col("status") == status)


def sales_lines(shop: Shop, status: str | None = None) -> DataFrame:
    """One row per order line joined to its order (inner, as every report does).

    Adds ``net_line_revenue`` = line revenue * (1 - discount) and
    ``line_profit`` = revenue - cost.
    """
    o = _orders(shop, status)
    line_cols = [c for c in shop.lines.columns if c not in ("discount_pct", "shipped_at")]
    l = shop.lines
    disc = F.col("l.discount_pct") if _per_line(shop, "discount_pct") else F.col("o.discount_pct")
    ship = F.col("l.shipped_at") if _per_line(shop, "shipped_at") else F.col("o.shipped_at")
    return (
        l.alias("l").join(o.alias("o"), F.col("l.order_id") == F.col("o.order_id"))
        .select(
            *[F.col(f"l.{c}") for c in line_cols],
            F.col("o.customer_id"), F.col("o.status"), F.col("o.channel"), F.col("o.ordered_at"),
            ship.alias("shipped_at"), disc.alias("discount_pct"),
            (F.col("l.line_revenue") * (F.lit(1) - disc)).alias("net_line_revenue"),
            (F.col("l.line_revenue") - F.col("l.line_cost")).alias("line_profit"),
        )
    )


def line_totals(lines: DataFrame) -> DataFrame:
    """Sums of an order's lines, one row per order_id."""
    aggs = [
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("quantity").alias("units"),
        F.sum("line_revenue").alias("revenue"),
        F.sum(F.col("line_revenue") - F.col("line_cost")).alias("profit"),
    ]
    if "discount_pct" in lines.columns:
        aggs.append(F.sum(F.col("line_revenue") * (F.lit(1) - F.col("discount_pct"))).alias("net_revenue"))
    if "shipped_at" in lines.columns:
        aggs += [F.sum(epoch_micros(F.col("shipped_at"))).alias("ship_at_micros"),
                 F.count("shipped_at").alias("ship_lines")]
    return lines.groupBy("order_id").agg(*aggs)


def join_totals(per_order: DataFrame, orders: DataFrame, line_columns: list[str], hint: str | None = None) -> DataFrame:
    """:func:`line_totals` joined to their orders, discount and ship time taken from where the layout has them."""
    joined = (per_order.hint(hint) if hint else per_order).join(orders, "order_id")
    net: Column = (F.col("net_revenue") if "discount_pct" in line_columns
                   else F.col("revenue") * (F.lit(1) - F.col("discount_pct")))
    if "shipped_at" in line_columns:
        ship_micros = (F.col("ship_at_micros") - F.col("ship_lines").cast("decimal(18,0)")
                       * epoch_micros(F.col("ordered_at"))).cast(MICROS)
        ship_lines = F.col("ship_lines")
    else:
        gap = micros_between(F.col("shipped_at"), F.col("ordered_at"))
        ship_micros = F.when(gap.isNotNull(), (gap * F.col("n_lines").cast("decimal(18,0)")).cast(MICROS))
        ship_lines = F.when(gap.isNotNull(), F.col("n_lines")).otherwise(F.lit(0).cast("bigint"))
    return joined.select(
        "order_id", "customer_id", "status", "channel", "ordered_at", "n_lines", "units",
        "revenue", net.alias("net_revenue"), "profit",
        ship_micros.alias("ship_micros"), ship_lines.alias("ship_lines"),
    )


def order_totals(shop: Shop, status: str | None = None) -> DataFrame:
    """Order grain: order attributes plus sums over the order's lines.

    Columns: order_id, customer_id, status, channel, ordered_at, n_lines,
    units, revenue, net_revenue, profit, ship_micros (sum over lines of
    shipped - ordered, microseconds), ship_lines (lines with a ship time).
    Orders without lines are absent (inner join, as in the reports). A shop with a
    written order grain (:func:`with_order_grain`) is read there.
    """
    if shop.totals is not None:
        return shop.totals if status is None else shop.totals.where(F.col("status") == status)
    return join_totals(line_totals(shop.lines), _orders(shop, status), shop.lines.columns)


def with_order_grain(shop: Shop, path: str) -> Shop:
    """``shop`` with its order grain written to ``path`` (shared storage), so that lines are read once for all reports.
    Money keeps its DECIMAL types, so reports over it are the same to the digit.
    """
    spark = shop.orders.sparkSession
    grain = order_totals(replace(shop, totals=None))
    grain.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return replace(shop, totals=spark.read.schema(grain.schema).parquet(path))


def order_product_totals(shop: Shop, status: str | None = COMPLETED) -> DataFrame:
    """(order, product) grain for product reports: lines of the order's status only.

    Columns: order_id, product_id, n_lines, units, revenue, profit,
    price_sum (sum of unit prices, for the average selling price).
    """
    keys = _orders(shop, status).select("order_id")
    # Semi join first: a sort-merge join leaves the lines partitioned by
    # order_id, which the (order, product) aggregate reuses (one shuffle).
    kept = shop.lines.join(keys, "order_id", "left_semi")
    return kept.groupBy("order_id", "product_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("quantity").alias("units"),
        F.sum("line_revenue").alias("revenue"),
        F.sum(F.col("line_revenue") - F.col("line_cost")).alias("profit"),
        F.sum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("price_n"),
    )
