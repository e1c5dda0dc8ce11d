"""The order grain stored by month: a month is replaced, and reported, without touching the others.

Files lie in ``month=YYYY-MM`` folders. A report of some months reads their folders only (partition
pruning), and a late or corrected month is written over its own folder only (dynamic partition
overwrite). Orders without a time are in a folder of their own.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import month_key
from tillroll.operators.facts import order_totals
from tillroll.sources.tables import Shop


def _of_months(shop: Shop, months: list[str] | None) -> DataFrame:
    """The order grain of the given months; their orders are found by a range of time that reaches the reader."""
    if months is not None:
        at = F.col("ordered_at")
        spans = [(F.lit(f"{m}-01").cast("timestamp_ntz"), F.add_months(F.lit(f"{m}-01").cast("date"), 1).cast("timestamp_ntz"))
                 for m in months]
        inside = F.lit(False)
        for lo, hi in spans:
            inside = inside | ((at >= lo) & (at < hi))
        shop = replace(shop, orders=shop.orders.where(inside), totals=None)
    return order_totals(shop).withColumn("month", month_key(F.col("ordered_at")))


def _write(grain: DataFrame, path: str, mode: str) -> None:
    # a month's rows meet in few files, but a month that holds a third of all rows is not one task's:
    # REBALANCE splits what grows beyond the advisory size
    (grain.hint("rebalance", "month").write.partitionBy("month").mode("overwrite").option("partitionOverwriteMode", mode)
     .option("compression", "zstd").parquet(path))


def write_months(shop: Shop, path: str) -> Shop:
    """Store all months of ``shop``'s order grain under ``path``; the shop that reports then read."""
    _write(_of_months(shop, None), path, "static")
    return open_months(shop, path)


def open_months(shop: Shop, path: str, months: list[str] | None = None) -> Shop:
    """``shop`` over the stored order grain; with ``months`` only their folders are read."""
    spark: SparkSession = shop.orders.sparkSession
    schema = _of_months(shop, None).schema
    grain = spark.read.schema(schema).parquet(path)
    if months is not None:
        grain = grain.where(F.col("month").isin(list(months)))
    return replace(shop, totals=grain)


def replace_months(shop: Shop, path: str, months: list[str]) -> None:
    """Recompute the given months from ``shop`` and write them over their folders; other folders stay as they are.

    A month of which no order is left loses its rows too: its folder is emptied.
    """
    grain = _of_months(shop, months)
    spark = shop.orders.sparkSession
    written = spark.read.schema(grain.schema).parquet(path)
    left = {r["month"] for r in grain.select("month").distinct().collect()}         # at most the months asked for
    _write(grain, path, "dynamic")
    for gone in set(months) - left:
        if not written.where(F.col("month") == gone).isEmpty():
            p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/month={gone}")
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
