"""Seeded shop data of the reference's shape, generated by Spark at any size.

Every random draw is a pure function of (seed, row id, purpose): a uniform
number from ``xxhash64``. Rows are generated where they are needed
(``explode`` of per-row counts), so the job scales with the number of
customers and no Python loop or driver-side list holds the rows. The
distributions are the reference's; the rows are not (its sequential Python
random stream cannot be reproduced in parallel). Order and item ids are
derived from the parent id, so they are unique but not dense.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources import schema as S
from tillroll.sources.tables import Shop, shop_from_tables

# --- Fixed values that must equal the reference's for the same distributions ---
CATEGORIES = [  # (category_id, name, parent_id)
    (1, "Electronics", None), (2, "Clothing", None), (3, "Home & Kitchen", None),
    (4, "Sports", None), (5, "Beauty", None),
    (6, "Laptops", 1), (7, "Phones", 1), (8, "Audio", 1),
    (9, "Tops", 2), (10, "Footwear", 2), (11, "Outerwear", 2),
]
PRODUCTS = [  # (product_id, category_id, unit_cost, unit_price)
    (1, 6, 8500, 14999),
    (2, 7, 6200, 11999),
    (3, 8, 1800, 3499),
    (4, 7, 5800, 10999),
    (5, 6, 7200, 13499),
    (6, 8, 1200, 2799),
    (7, 10, 450, 1199),
    (8, 9, 280, 699),
    (9, 11, 1100, 2499),
    (10, 3, 3200, 6999),
    (11, 3, 650, 1299),
    (12, 4, 180, 449),
    (13, 4, 320, 699),
    (14, 5, 180, 399),
    (15, 5, 620, 1199),
]
SOURCES = ["google", "facebook", "instagram", "referral", "organic", "tiktok", "email"]
SEGMENT_DRAW = ["B2C", "B2C", "B2C", "B2B", "VIP"]
STATUS_DRAW = ["completed", "completed", "completed", "completed", "returned", "cancelled", "pending"]
CHANNEL_WEIGHTS = [("web", 40), ("mobile", 30), ("store", 20), ("marketplace", 10)]
ORDERS_PER_CUSTOMER = [(1, 20), (2, 25), (3, 20), (4, 15), (5, 12), (6, 8)]
DISCOUNTS = [("0", 55), ("0.05", 20), ("0.10", 12), ("0.15", 8), ("0.20", 5)]
LINES_PER_ORDER = [(1, 60), (2, 30), (3, 10)]
QUANTITIES = [(1, 70), (2, 20), (3, 10)]
SPEND_BASE = [("google", 45000), ("facebook", 32000), ("instagram", 28000), ("tiktok", 18000),
              ("email", 8000)]
SPEND_FACTOR = (0.7, 1.4)
START = "2022-01-01"
END = "2023-12-31"
ACQUIRE_DAYS = 700
SHIP_DAYS = (1, 5)
# --- end of fixed values --------------------------------------------------------

# Names decide no distribution: they are made from numbers.
GIVEN_NAMES, FAMILY_NAMES, CITIES = 30, 30, 10
LAUNCHED = dt.date(2022, 1, 1)

_PRIME = 2_147_483_647


def uniform(seed: int, *parts) -> Column:
    """A uniform number in [0, 1) that depends only on ``seed`` and ``parts``."""
    cols = [F.lit(seed)] + [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.pmod(F.xxhash64(*cols), F.lit(_PRIME)) / F.lit(float(_PRIME))


def randint(seed: int, lo: Column | int, hi: Column | int, *parts) -> Column:
    """Uniform integer in [lo, hi] (both ends included)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return (lo_c + F.floor(uniform(seed, *parts) * (hi_c - lo_c + 1))).cast("int")


def pick(seed: int, values: list, *parts) -> Column:
    """Uniform choice from ``values``."""
    idx = F.floor(uniform(seed, *parts) * len(values)).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1)


def weighted(seed: int, pairs: list[tuple], *parts) -> Column:
    """Choice from (value, weight) pairs by cumulative weight."""
    total = float(sum(w for _, w in pairs))
    u = uniform(seed, *parts)
    acc, expr = 0.0, None
    for value, w in pairs[:-1]:
        acc += w / total
        expr = (F.when(u < acc, F.lit(value)) if expr is None else expr.when(u < acc, F.lit(value)))
    last = F.lit(pairs[-1][0])
    return last if expr is None else expr.otherwise(last)


def synth_shop(spark: SparkSession, customer_ids: DataFrame | None = None,
               n_customers: int = 1500, seed: int = 42) -> Shop:
    """Six tables of the reference's shape.

    ``customer_ids`` (a one-column DataFrame of ids) drives the size; without
    it ids 1..``n_customers`` come from ``spark.range``.
    """
    ids = (customer_ids.select(F.col(customer_ids.columns[0]).cast("long").alias("customer_id"))
           if customer_ids is not None
           else spark.range(1, n_customers + 1).select(F.col("id").alias("customer_id")))
    cid = F.col("customer_id")
    start, end = F.to_date(F.lit(START)), F.to_date(F.lit(END))

    categories = spark.createDataFrame(CATEGORIES, S.CATEGORIES)
    products = spark.createDataFrame(
        [(p, f"Product {p}", c, _dec(uc), _dec(up), LAUNCHED, 1) for p, c, uc, up in PRODUCTS], S.PRODUCTS)

    first = F.concat(F.lit("Given"), randint(seed, 1, GIVEN_NAMES, "first", cid).cast("string"))
    last = F.concat(F.lit("Family"), randint(seed, 1, FAMILY_NAMES, "last", cid).cast("string"))
    customers = ids.select(
        cid,
        F.concat(first, F.lit(" "), last).alias("full_name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), cid.cast("string"), F.lit("@mail.com")).alias("email"),
        F.concat(F.lit("City "), randint(seed, 1, CITIES, "city", cid).cast("string")).alias("city"),
        F.lit("ZA").alias("country"),
        pick(seed, SEGMENT_DRAW, "segment", cid).alias("segment"),
        F.date_add(start, randint(seed, 0, ACQUIRE_DAYS, "acq", cid)).alias("acquired_at"),
        pick(seed, SOURCES, "src", cid).alias("referral_src"),
    )

    k = F.col("k")
    acq = F.col("acquired_at")
    span = F.least(F.lit(ACQUIRE_DAYS), F.datediff(end, acq) + 1)
    o = (customers.select("customer_id", "acquired_at",
                          F.explode(F.sequence(F.lit(1), weighted(seed, ORDERS_PER_CUSTOMER, "n", cid)))
                          .alias("k"))
         .withColumn("order_id", cid * 8 + k)
         .withColumn("day", F.date_add(acq, randint(seed, 1, span, "day", cid, k)))
         .where(F.col("day") <= end))
    oid = F.col("order_id")
    status = pick(seed, STATUS_DRAW, "status", oid)
    ordered = F.col("day").cast("timestamp_ntz")
    orders = o.select(
        "order_id", "customer_id", status.alias("status"),
        weighted(seed, CHANNEL_WEIGHTS, "channel", oid).alias("channel"),
        ordered.alias("ordered_at"),
        F.when(status == "completed",
               F.date_add(F.col("day"), randint(seed, SHIP_DAYS[0], SHIP_DAYS[1], "ship", oid))
               .cast("timestamp_ntz")).alias("shipped_at"),
        weighted(seed, DISCOUNTS, "disc", oid).cast(S.RATE).alias("discount_pct"),
    )

    # Distinct products per order: the first n of all products ordered by a seeded hash.
    prod = products.select("product_id", "unit_cost", "unit_price")
    n_lines = weighted(seed, LINES_PER_ORDER, "lines", oid)
    pid_order = F.array_sort(F.transform(
        F.array(*[F.lit(p[0]) for p in PRODUCTS]),
        lambda p: F.struct(F.xxhash64(F.lit(seed), F.lit("pick"), oid, p).alias("h"), p.alias("p"))))
    chosen = F.slice(F.transform(pid_order, lambda s: s["p"]), 1, n_lines)
    items = (orders.select("order_id", "discount_pct",
                           F.posexplode(chosen).alias("j", "product_id"))
             .join(F.broadcast(prod), "product_id")   # 15 rows, fixed
             .select(
                 (F.col("order_id") * 4 + F.col("j")).alias("item_id"),
                 "order_id", F.col("product_id").cast("long").alias("product_id"),
                 weighted(seed, QUANTITIES, "qty", F.col("order_id"), F.col("product_id"))
                 .cast("int").alias("quantity"),
                 (F.col("unit_price") * (F.lit(1) - F.col("discount_pct"))).cast(S.MONEY).alias("unit_price"),
                 F.col("unit_cost").cast(S.MONEY).alias("unit_cost")))

    # 24 months x 5 channels: both lists are fixed, expanded with explode.
    grid = (spark.range(0, 24).select(
        F.date_format(F.add_months(start, F.col("id").cast("int")), "yyyy-MM").alias("month"),
        F.col("id").alias("m"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.lit(b).alias("base"))
                            for c, b in SPEND_BASE])).alias("cb"))
        .select("month", "m", F.col("cb.channel").alias("channel"), F.col("cb.base").alias("base")))
    lo, hi = SPEND_FACTOR
    spend = (grid
             .select((F.col("m") * 8 + F.pmod(F.xxhash64("channel"), F.lit(8))).alias("spend_id"), "month", "channel",
                     F.round(F.col("base") * (F.lit(lo) + (hi - lo) * uniform(seed, "spend", F.col("month"),
                                                                             F.col("channel"))), 2)
                     .cast(S.MONEY).alias("spend_zar")))

    return shop_from_tables({
        "categories": categories, "products": products, "customers": customers,
        "orders": orders, "order_items": items, "marketing_spend": spend,
    })


def synth_tables(shop: Shop) -> dict[str, DataFrame]:
    """The six native tables of a generated shop, with exactly their declared columns and types."""
    tables = {n: shop.table(n) for n in S.TABLES}
    tables["order_items"] = tables["order_items"].withColumn("unit_cost", F.col("line_cost") / F.col("quantity"))
    return {n: df.select(*[F.col(f.name).cast(f.dataType) for f in S.TABLES[n].fields]) for n, df in tables.items()}


def _dec(x):
    from decimal import Decimal
    return Decimal(x).quantize(Decimal("0.01"))
