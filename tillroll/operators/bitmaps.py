"""Exact distinct customers at several grains from mergeable bitmaps.

``COUNT(DISTINCT customer_id)`` by month says nothing about the quarter: sets must be united, not
counts added. Here a month's customers are kept as bitmaps, one of 4 KB for each block of 32,768 ids
(month, block, bitmap). Bitmaps unite by OR, so quarter, year and total come from the
months' bitmaps, a new month is added without reading old orders, and no aggregate expands its
input once per distinct set.

Ids are whole numbers of any sign and should be dense (surrogate keys): a block of which a month has
one id costs as much as a full one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import month_key

# level -> period of a month 'YYYY-MM'
PERIODS = {
    "month": F.col,
    "quarter": lambda m: F.concat(F.substring(m, 1, 4), F.lit("-Q"),
                                  F.ceil(F.substring(m, 6, 2).cast("int") / 3).cast("string")),
    "year": lambda m: F.substring(m, 1, 4),
    "total": lambda m: F.lit("all"),
}


def id_bitmaps(rows: DataFrame, month: str, ids: str) -> DataFrame:
    """(month, block, bitmap) of the distinct ``ids`` of each month; NULL ids are not counted, a NULL month is one of its own."""
    v = F.col(ids).cast("bigint")
    return (rows.where(v.isNotNull())
            .groupBy(F.col(month).alias("month"), F.bitmap_bucket_number(v).alias("block"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("bitmap")))


def customer_bitmaps(orders: DataFrame) -> DataFrame:
    """Bitmaps of the customers of ``orders`` (ordered_at, customer_id) by month."""
    return id_bitmaps(orders.select(month_key(F.col("ordered_at")).alias("month"), "customer_id"), "month", "customer_id")


def merge(*bitmaps: DataFrame) -> DataFrame:
    """One bitmap for each month and block: the union of sets that may overlap (a late delivery, a repeated one)."""
    return reduce(DataFrame.unionByName, bitmaps).groupBy("month", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def unique_ids(bitmaps: DataFrame, levels=("month", "quarter", "year", "total")) -> DataFrame:
    """(level, period, unique_ids) from bitmaps by month.

    Each bitmap goes to its period of every level; periods unite block by block (map-side first), then the
    blocks' counts are summed. Of a period at most one bitmap a block meets in a task.
    """
    period = F.array(*[F.struct(F.lit(x).alias("level"), PERIODS[x]("month").alias("period")) for x in levels])
    spread = bitmaps.select(F.explode(period).alias("p"), "block", "bitmap")
    united = spread.groupBy("p", "block").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    return united.groupBy("p").agg(F.sum("n").cast("bigint").alias("unique_ids")).select("p.level", "p.period", "unique_ids")


def unique_customers(orders: DataFrame, levels=("month", "quarter", "year", "total")) -> DataFrame:
    """(level, period, unique_customers) of ``orders``, read once."""
    return unique_ids(customer_bitmaps(orders), levels).withColumnRenamed("unique_ids", "unique_customers")
