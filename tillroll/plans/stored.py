"""Queries over stored layouts: each stores what the driver's tables give in one of the layouts of ``sources`` and reads it back.

Scratch folders lie under ``spark.checkpoint.dir`` and go when the application ends.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.dates import iso_datetime, month_key
from tillroll.functions.numeric import money, to_double
from tillroll.operators import bitmaps, quality, rules
from tillroll.operators.ordering import global_lag
from tillroll.plans import exports, revenue, sqltext
from tillroll.session import delete_on_exit
from tillroll.sources import bucketed, monthly, sinks
from tillroll.sources import schema as S
from tillroll.sources.keyed import KeyedTable
from tillroll.sources.tables import Shop, star_tables


def _scratch(spark: SparkSession, name: str) -> str:
    path = sinks.shared_path(spark, name)
    delete_on_exit(spark, path)
    return path


# --- facts ----------------------------------------------------------------------

def order_grain_bucketed(shop: Shop) -> DataFrame:
    """The order grain from orders and lines stored in buckets of order_id."""
    spark = shop.orders.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    facts = bucketed.write_bucketed(shop, buckets)
    out = bucketed.bucketed_order_totals(facts)
    facts.drop()                                   # the names only: the files stay until the application ends
    return out.select("order_id", "customer_id", "status", "channel", iso_datetime(F.col("ordered_at")).alias("ordered_at"),
                      "n_lines", "units", *[to_double(F.col(c)).alias(c) for c in ("revenue", "net_revenue", "profit")],
                      F.col("ship_micros").cast("bigint").alias("ship_micros"), "ship_lines")


def export_all(shop: Shop) -> DataFrame:
    """All exports in one run over a shared order grain; the runner's log figures."""
    return exports.export_all(shop, _scratch(shop.orders.sparkSession, "all"))


def unique_customers(shop: Shop) -> DataFrame:
    """Customers with a completed order by month, quarter, year and in total, from bitmaps."""
    return bitmaps.unique_customers(shop.orders.where("status = 'completed'"))


def order_gaps(shop: Shop) -> DataFrame:
    """Every order with the one before it in time (all customers) and the microseconds between them."""
    timed = shop.orders.select("order_id", "ordered_at")
    out = global_lag(timed, "ordered_at", {"order_id": "prev_order_id", "ordered_at": "prev_at"}, tiebreak="order_id")
    gap = F.timestamp_diff("MICROSECOND", F.col("prev_at"), F.col("ordered_at"))
    return out.select("order_id", "prev_order_id", gap.alias("gap_micros"))


def month_replaced(shop: Shop) -> DataFrame:
    """Monthly revenue after the last month, first stored with its orders still pending, was replaced in the monthly layout."""
    spark = shop.orders.sparkSession
    path = _scratch(spark, "months")
    last = shop.orders.agg(F.max(month_key(F.col("ordered_at"))).alias("m")).first()["m"]
    early = F.when(month_key(F.col("ordered_at")) == F.lit(last), F.lit("pending")).otherwise(F.col("status"))
    monthly.write_months(replace(shop, orders=shop.orders.withColumn("status", early)), path)
    if last is not None:
        monthly.replace_months(shop, path, [last])
    return revenue.monthly_revenue(monthly.open_months(shop, path))


# --- rules ------------------------------------------------------------------------

def _text(c: str):
    return F.coalesce(F.col(c).cast("string"), F.lit("NULL"))


def row_violations(shop: Shop, declared) -> DataFrame:
    """Offending rows of all tables: table, row_key, failed (rule names), rows."""
    tables = {n: shop.table(n) for n in S.TABLES}
    counts: dict[str, int] = {}
    out = None
    for name in tables:
        pk = next(cols for t, kind, cols, _ in declared if t == name and kind == "pk")
        found = rules.row_violations(tables, name, declared, counts)
        part = found.select("table", F.concat_ws("|", *[_text(c) for c in pk]).alias("row_key"),
                            F.array_join("failed", " ").alias("failed"), "rows")
        out = part if out is None else out.unionByName(part)
    n = rules.parts(shop.orders.sparkSession, sum(counts[name] for name in tables))
    return rules.totals(out, ("table", "row_key", "failed"), F.col("rows"), "rows", n)


APPEND_RULES = [
    ("orders", "pk", ("order_id",), None),
    ("orders", "not_null", ("ordered_at",), None),
    ("orders", "check_in", ("channel",), ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")),
    ("orders", "fk", ("customer_id",), ("customers", "customer_id")),
]
FIRST_DELIVERY = dt.datetime(1998, 1, 1)


def checked_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of a second delivery of orders onto a stored first one.

    The first delivery is what was ordered before 1998. The second is every order, the urgent ones
    sent once more as returned. Customers in debt are no parents, and one channel is not allowed.
    """
    shop = star_tables(spark, sf_dir)
    parents = {"customers": spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_acctbal >= 0")
               .select(F.col("c_custkey").alias("customer_id"))}
    schema = T.StructType([f for f in S.ORDERS.fields if f.name in shop.orders.columns])
    table = KeyedTable(spark, _scratch(spark, "orders"), "orders", schema, APPEND_RULES)
    table.append(shop.orders.where(F.col("ordered_at") < F.lit(FIRST_DELIVERY).cast("timestamp_ntz")), parents, "first")
    again = shop.orders.where("channel = '1-URGENT'").withColumn("status", F.lit("returned"))
    out = table.append(shop.orders.unionByName(again), parents, "second")
    return out.select("order_id", "status", "verdict", F.array_join("failed", " ").alias("failed"), "rows")


# --- text -------------------------------------------------------------------------

DELIVERED = T.StructType([T.StructField("order_id", T.LongType(), False), T.StructField("customer_id", T.LongType(), False),
                          T.StructField("total", S.MONEY, True), T.StructField("channel", T.StringType(), True)])


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV lines of mixed quality, read back: every line is a good row or in quarantine.

    Medium orders come without a price, in words; low ones lack a field and unspecified ones have one too many; no
    customer is given for urgent orders that were returned.
    """
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    price = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("n/a")).otherwise(money("o_totalprice").cast("string"))
    who = F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O"), F.lit("")).otherwise(
        F.col("o_custkey").cast("string"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), who, price)
    line = (F.when(F.col("o_orderpriority") == "5-LOW", line)
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat_ws(",", line, "o_orderpriority", F.lit("x")))
            .otherwise(F.concat_ws(",", line, "o_orderpriority")))
    path = _scratch(spark, "lines")
    o.select(line.alias("value")).write.text(path)
    good, bad = sinks.read_records(spark, path, DELIVERED, header=False)
    return good.select("order_id", "customer_id", to_double(F.col("total")).alias("total"), "channel",
                       F.lit(None).cast("string").alias("record"), F.lit("good").alias("outcome")).unionByName(
        bad.select(F.split("record", ",")[0].cast("bigint").alias("order_id"), F.lit(None).cast("bigint").alias("customer_id"),
                   F.lit(None).cast("double").alias("total"), F.lit(None).cast("string").alias("channel"),
                   "record", F.col("reason").alias("outcome")))


def defaults_by_table(shop: Shop) -> DataFrame:
    """Declared defaults of customers, products and orders that come without those columns: table, row_key, column, value."""
    out = None
    for name, key in (("customers", "customer_id"), ("products", "product_id"), ("orders", "order_id")):
        columns = list(S.DEFAULTS[name])
        filled = quality.apply_defaults(shop.table(name).drop(*columns), name)
        value = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
        part = filled.select(F.lit(name).alias("table"), F.col(key).alias("row_key"), value.alias("v")).select(
            "table", "row_key", "v.column", "v.value")
        out = part if out is None else out.unionByName(part)
    return out


def sql_customer_metrics(shop: Shop) -> DataFrame:
    """The SQL text of customer metrics for returned orders as of a date."""
    return sqltext.customer_metrics(shop, "returned", dt.date(1999, 6, 30))


def sql_customer_metrics_latest(shop: Shop) -> DataFrame:
    """The same text for completed orders as of the last one, by its scalar subquery."""
    return sqltext.customer_metrics(shop, "completed")
