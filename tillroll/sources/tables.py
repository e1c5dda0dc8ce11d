"""Readers: the six native tables, and the driver's star schema seen as a shop.

Every reader returns a :class:`Shop`: lazy DataFrames only, no action is run.
``lines`` is the order-item table normalised to one shape whatever the source:

    order_id, item_id, product_id, quantity, unit_price (money),
    line_revenue (= unit_price * quantity, money), line_cost (money)
    [, discount_pct, shipped_at]   -- only when the source keeps them per line

When ``discount_pct`` / ``shipped_at`` are absent from ``lines`` they are read
from ``orders`` (the native layout).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import month_key
from tillroll.functions.numeric import money, rate, round_div_decimal
from tillroll.sources import schema as S
from tillroll.sources import sinks


@dataclass(frozen=True)
class Shop:
    customers: DataFrame
    orders: DataFrame
    lines: DataFrame
    products: DataFrame
    categories: DataFrame
    spend: DataFrame
    totals: DataFrame | None = None   # a written order grain (operators.facts.with_order_grain)

    def table(self, name: str) -> DataFrame:
        return {
            "customers": self.customers, "orders": self.orders,
            "order_items": self.lines, "products": self.products,
            "categories": self.categories, "marketing_spend": self.spend,
        }[name]


def _read(spark: SparkSession, path: str, name: str, fmt: str) -> DataFrame:
    reader = spark.read.schema(S.TABLES[name])
    if fmt == "csv":
        return sinks.import_csv(spark, f"{path}/{name}", S.TABLES[name])
    if fmt == "json":
        return reader.json(f"{path}/{name}")
    return reader.format(fmt).load(f"{path}/{name}")


def load_tables(spark: SparkSession, path: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read the six native tables (``path/<table>``) with their declared schema."""
    return {name: _read(spark, path, name, fmt) for name in S.TABLES}


def shop_from_tables(tables: dict[str, DataFrame]) -> Shop:
    """Wrap native tables as a :class:`Shop` (adds line_revenue / line_cost)."""
    items = tables["order_items"]
    lines = items.select(
        "order_id", "item_id", "product_id", "quantity", "unit_price",
        money(F.col("unit_price") * F.col("quantity")).alias("line_revenue"),
        money(F.col("unit_cost") * F.col("quantity")).alias("line_cost"),
    )
    return Shop(
        customers=tables["customers"], orders=tables["orders"], lines=lines,
        products=tables["products"], categories=tables["categories"],
        spend=tables["marketing_spend"],
    )


def load_shop(spark: SparkSession, path: str, fmt: str = "parquet") -> Shop:
    return shop_from_tables(load_tables(spark, path, fmt))


# ---------------------------------------------------------------------------
# The driver's TPC-H-like tables through the adapter (FIXTURES.md, part B).
# ---------------------------------------------------------------------------

def _status(orderstatus, orderkey):
    """F -> completed, O -> returned, P -> cancelled (even key) or pending.

    Written as nested single-branch CASEs on null-safe tests: the optimizer
    then reduces ``status = 'completed'`` to ``o_orderstatus <=> 'F'``, which
    reaches the Parquet reader as a pushed filter. (A NULL source status still
    maps to NULL, and a NULL key to 'pending', as the plain CASE would.)
    """
    return F.when(orderstatus.eqNullSafe("F"), "completed").otherwise(
        F.when(orderstatus.eqNullSafe("O"), "returned").otherwise(
            F.when(orderstatus.eqNullSafe("P"),
                   F.when((orderkey % 2).eqNullSafe(0), "cancelled").otherwise("pending"))))


def star_tables(spark: SparkSession, sf_dir: str, line_parts: int | None = None) -> Shop:
    """The star schema under ``sf_dir`` mapped onto the shop tables.

    customers  <- customer (+ nation, region; referral = type of the user's
                  first event, else 'organic'; acquired = first order date)
    orders     <- orders (status F/O/P mapped, channel = priority)
    lines      <- lineitem; cost from part.p_retailprice * quantity; discount
                  and ship date kept per line
    products   <- part (category = p_type), spend <- events by month, type

    With ``line_parts`` lines and costs meet in that many partitions, not in the session's number.
    """
    def rd(t: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{t}.parquet")

    nation = rd("nation").select("n_nationkey", "n_name", "n_regionkey")
    region = rd("region").select("r_regionkey", "r_name")
    events = rd("events")
    raw_orders = rd("orders")

    # Aggregates keyed by the join key: when a report uses none of their
    # columns, the optimizer removes the whole left join.
    first_event = events.groupBy(F.col("user_id").alias("customer_id")).agg(
        F.min_by("event_type", F.struct("ts", "event_id")).alias("first_event_type"))
    first_order = raw_orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min(F.to_date("o_orderdate")).alias("acquired_at"))

    geo = nation.join(region, nation.n_regionkey == region.r_regionkey, "left").groupBy("n_nationkey").agg(
        F.max("n_name").alias("city"), F.max("r_name").alias("country"))

    customers = (
        rd("customer")
        .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"),
                F.col("c_nationkey"), F.col("c_mktsegment").alias("segment"))
        .join(geo, F.col("c_nationkey") == geo.n_nationkey, "left")
        .join(first_event, "customer_id", "left")
        .join(first_order, "customer_id", "left")
        .select(
            "customer_id", "full_name",
            F.concat(F.lower(F.regexp_replace("full_name", "[^A-Za-z0-9]+", ".")),
                     F.lit("@mail.example")).alias("email"),
            "city", "country", "segment", "acquired_at",
            F.coalesce("first_event_type", F.lit("organic")).alias("referral_src"),
        )
    )

    orders = raw_orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _status(F.col("o_orderstatus"), F.col("o_orderkey")).alias("status"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderdate").alias("ordered_at"),
    )

    part = rd("part")
    costed = part.repartition(line_parts, "p_partkey") if line_parts else part
    part_cost = costed.groupBy(F.col("p_partkey").alias("product_id")).agg(
        F.max(money("p_retailprice")).alias("part_cost"))
    li = rd("lineitem")
    qty = F.round("l_quantity").cast("int")   # whole already; a fraction would round, not be cut
    revenue = money("l_extendedprice")
    lines = (
        li.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").cast("bigint").alias("item_id"),
            F.col("l_partkey").alias("product_id"),
            qty.alias("quantity"),
            round_div_decimal(revenue, qty, 2, num_scale=2).cast(S.MONEY).alias("unit_price"),
            revenue.alias("line_revenue"),
            rate("l_discount").alias("discount_pct"),
            F.col("l_shipdate").alias("shipped_at"),
        )
        .join(part_cost, "product_id", "left")
        .select("order_id", "item_id", "product_id", "quantity", "unit_price", "line_revenue",
                money(F.col("part_cost") * F.col("quantity")).alias("line_cost"),
                "discount_pct", "shipped_at")
    )

    products = part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
        F.when(F.col("p_type").isNotNull(), F.xxhash64("p_type")).alias("category_id"),
        money("p_retailprice").alias("unit_cost"),
        money("p_retailprice").alias("unit_price"),
    )
    categories = part.where(F.col("p_type").isNotNull()).groupBy("p_type").agg(
        F.xxhash64("p_type").alias("category_id")).select(
        "category_id", F.col("p_type").alias("name"), F.lit(None).cast("bigint").alias("parent_id"))

    spend = (
        events.groupBy(month_key(F.col("ts")).alias("month"),
                       F.col("event_type").alias("channel"))
        .agg(F.sum(money("value")).alias("spend_zar"))
        .select(F.xxhash64("month", "channel").alias("spend_id"), "month", "channel",
                money("spend_zar").alias("spend_zar"))
    )
    return Shop(customers=customers, orders=orders, lines=lines, products=products,
                categories=categories, spend=spend)


def register_views(shop: Shop, prefix: str = "") -> list[str]:
    """Expose the shop as temp views (``orders``, ``order_items`` ...) for SQL text.

    Also registers ``sales_lines`` (lines joined to orders, discount and ship
    time resolved), the one view that reads the same for native and adapter
    layouts. Returns the view names.
    """
    from tillroll.operators.facts import sales_lines
    names = []
    for name in S.TABLES:
        shop.table(name).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    sales_lines(shop).createOrReplaceTempView(prefix + "sales_lines")
    names.append(prefix + "sales_lines")
    return names
