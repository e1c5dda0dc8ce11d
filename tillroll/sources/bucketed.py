"""Orders and lines stored in buckets of ``order_id``, and the order grain over them without a shuffle.

Every report that reads lines sums them per order and joins the orders. Stored in buckets
of the same key, both sides already lie as that needs: the aggregate and the join run
bucket by bucket, with no Exchange above either scan.

A bucket is one task, so an order that holds more than a bucket's share of the lines would make
that task slow. Lines of such *heavy* orders (fewer than there are buckets, by their definition) and lines
without an order id are stored apart, unbucketed; their sums are partial
aggregates of many tasks, one row each in the end.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.facts import join_totals, line_totals
from tillroll.session import checkpoint_dir, delete_on_exit
from tillroll.sources.tables import Shop


@dataclass(frozen=True)
class BucketedFacts:
    """Names of the three tables and their common bucket count."""
    spark: SparkSession
    name: str
    buckets: int

    @property
    def orders(self) -> DataFrame:
        return self.spark.table(f"{self.name}_orders")

    @property
    def lines(self) -> DataFrame:
        """Lines of all but the heavy orders."""
        return self.spark.table(f"{self.name}_lines")

    @property
    def heavy_lines(self) -> DataFrame:
        return self.spark.table(f"{self.name}_heavy_lines")

    def drop(self) -> None:
        for t in ("orders", "lines", "heavy_lines"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{t}")


def heavy_orders(lines: DataFrame, buckets: int) -> DataFrame:
    """order_id of orders with more than a bucket's share of all lines: fewer than ``buckets`` rows."""
    total = lines.where("order_id IS NOT NULL").count()
    counts = lines.where("order_id IS NOT NULL").groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") * F.lit(buckets) > F.lit(total)).select("order_id")


def write_bucketed(shop: Shop, buckets: int, name: str | None = None, path: str | None = None) -> BucketedFacts:
    """Store ``shop``'s orders and lines in ``buckets`` buckets of order_id, one sorted file a bucket.

    ``path`` is a folder on shared storage (``spark.checkpoint.dir`` if not given, then removed when the
    application ends). The tables keep every row and column. A shuffle of the lines on
    order_id is paid here once, instead of in every report.
    """
    spark = shop.orders.sparkSession
    name = name or f"tillroll_facts_{uuid.uuid4().hex[:12]}"
    if path is None:
        root = checkpoint_dir(spark)
        if not root:
            raise RuntimeError("spark.checkpoint.dir is not set; pass an explicit shared path")
        path = f"{root.rstrip('/')}/{name}"
        delete_on_exit(spark, path)
    heavy = F.broadcast(heavy_orders(shop.lines, buckets))     # fewer rows than buckets
    apart = shop.lines.join(heavy, "order_id", "left_semi").select(*shop.lines.columns) \
        .unionByName(shop.lines.where("order_id IS NULL"))
    kept = shop.lines.where("order_id IS NOT NULL").join(heavy, "order_id", "left_anti").select(*shop.lines.columns)
    for what, df in (("orders", shop.orders), ("lines", kept)):
        # the bucket is pmod(hash, buckets) for repartition and bucketBy alike, so each task writes one file
        (df.repartition(buckets, "order_id").write.mode("overwrite").format("parquet")
         .bucketBy(buckets, "order_id").sortBy("order_id")
         .option("path", f"{path}/{what}").saveAsTable(f"{name}_{what}"))
    apart.write.mode("overwrite").format("parquet").option("path", f"{path}/heavy_lines").saveAsTable(f"{name}_heavy_lines")
    return BucketedFacts(spark, name, buckets)


def open_bucketed(spark: SparkSession, name: str) -> BucketedFacts:
    """Tables that :func:`write_bucketed` stored earlier, under the same catalog."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}_lines").where("col_name = 'Num Buckets'").first()
    return BucketedFacts(spark, name, int(described["data_type"]))


def bucketed_order_totals(facts: BucketedFacts, status: str | None = None) -> DataFrame:
    """As ``operators.facts.order_totals``, read from the buckets.

    The bucketed part has no Exchange: lines are summed where they lie and meet their
    orders bucket by bucket. The heavy orders' part moves a few rows per task.
    """
    orders = facts.orders if status is None else facts.orders.where(F.col("status") == status)
    rest = join_totals(line_totals(facts.lines), orders, facts.lines.columns, hint="merge")
    heavy = line_totals(facts.heavy_lines.where("order_id IS NOT NULL"))
    apart = join_totals(heavy, orders, facts.lines.columns, hint="broadcast")   # fewer rows than buckets
    return rest.unionByName(apart)


def shop_over_buckets(shop: Shop, facts: BucketedFacts) -> Shop:
    """``shop`` whose reports read the order grain from the buckets; a report's status filter reaches the orders' scan."""
    return replace(shop, totals=bucketed_order_totals(facts))
