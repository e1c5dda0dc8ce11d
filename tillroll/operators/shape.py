"""Post-processing of report results (pandas in the reference's dashboard and runner).

All inputs are small report results (one row per month, channel, segment or
product name); the operators stay DataFrame expressions anyway: a fixed-list
pivot (no extra job to find the values), ``orderBy().limit()`` for top-n
(a distributed top-k), one-row aggregates cross-joined for the KPI row.

Text labels round the exact decimal value half away from zero. Python's
float formatting in the reference rounds the binary double instead, so a
value such as 2.65 may print as "2.6" there and "2.7" here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's display rules.
RETURN_RATE_LIMIT = 10.0      # return rate above this (percent) is flagged
BREAK_EVEN_ROAS = 1.0         # ROAS at or above this is profitable
TOP_N = 10                    # products shown in the top-products chart


def cohort_matrix(retention: DataFrame, months: range = range(0, 6),
                  value: str = "retention_pct") -> DataFrame:
    """Long cohort rows -> one row per cohort, ``month_<n>`` columns, holes 0."""
    wide = (retention.groupBy("cohort_month")
            .pivot("month_number", list(months))
            .agg(F.first(value)))
    return wide.select("cohort_month", *[
        F.coalesce(F.col(str(m)), F.lit(0.0)).alias(f"month_{m}") for m in months])


def money_k(c: Column) -> Column:
    """'R12K': thousands, no decimals (half to even, as Python's format)."""
    k = F.bround(c.cast("decimal(38,2)") / F.lit(1000), 0).cast("bigint")
    return F.concat(F.lit("R"), k.cast("string"), F.lit("K"))


def money_grouped(c: Column) -> Column:
    """'R1,234': whole Rand with thousands separators (half away from zero)."""
    return F.concat(F.lit("R"), F.format_number(F.round(c.cast("decimal(38,2)"), 0), 0))


def ratio_x(c: Column) -> Column:
    """'2.6x' from a ROAS value."""
    return F.when(c.isNotNull(), F.concat(
        F.format_string("%.1f", F.round(c.cast("decimal(38,2)"), 1).cast("double")), F.lit("x")))


def title_case(c: Column) -> Column:
    """Python ``str.title``: upper after any non-letter, lower elsewhere."""
    chars = F.split(c, "")
    return F.array_join(F.transform(chars, lambda ch, i: F.when(
        (i == 0) | ~F.substring(c, i, 1).rlike(r"\p{L}"), F.upper(ch)).otherwise(F.lower(ch))), "")


def top_products(products: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top ``n`` product rows by revenue (ties: product, category), shown ascending."""
    top = products.orderBy(F.col("revenue").desc_nulls_last(), "product", "category").limit(n)
    return top.select("product", "category", "revenue", "profit",
                      money_k(F.col("revenue")).alias("revenue_label")
                      ).orderBy(F.col("revenue").asc_nulls_first(), F.col("product").desc(),
                                F.col("category").desc())


def paid_channels(roi: DataFrame) -> DataFrame:
    """Channels with a ROAS, ascending, with the break-even verdict and a '2.6x' label."""
    d = roi.where(F.col("roas").isNotNull())
    return d.select(
        "channel", "roas", ratio_x(F.col("roas")).alias("roas_label"),
        F.when(F.col("roas") >= BREAK_EVEN_ROAS, "profitable").otherwise("underwater").alias("verdict"),
    ).orderBy("roas", "channel")


def return_flags(channels: DataFrame, limit: float = RETURN_RATE_LIMIT) -> DataFrame:
    """Channel cards: upper-case name, AOV text, return text and the > limit flag."""
    return channels.select(
        "channel",
        F.upper("channel").alias("channel_label"),
        F.concat(money_grouped(F.col("avg_order_value")), F.lit(" AOV")).alias("aov_label"),
        F.concat(F.format_string("%.1f", F.col("return_rate_pct")), F.lit("% returns")).alias("returns_label"),
        (F.col("return_rate_pct") > limit).alias("high_returns"),
    )


def kpi_summary(trend: DataFrame, products: DataFrame, channels: DataFrame) -> DataFrame:
    """One row: total_revenue, total_orders, avg_margin, top_product, top_channel.

    ``avg_margin`` is the plain mean of the monthly rounded margins (tenths
    summed as integers, then one division).
    """
    totals = trend.agg(
        F.sum(F.col("net_revenue").cast("decimal(38,2)")).cast("double").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        (F.sum(F.round(F.col("margin_pct") * 10).cast("decimal(38,0)")).cast("double")
         / (F.count("margin_pct") * F.lit(10.0))).alias("avg_margin"),
    )
    top_p = (products.orderBy(F.col("revenue").desc_nulls_last(), "product", "category")
             .limit(1).select(F.col("product").alias("top_product")))
    top_c = (channels.orderBy(F.col("net_revenue").desc_nulls_last(), "channel")
             .limit(1).select(F.col("channel").alias("top_channel")))
    # three global aggregates of one row each: joining them is 1 x 1 x 1
    return (totals.crossJoin(F.broadcast(top_p)).crossJoin(F.broadcast(top_c)))


def display_labels(kpi: DataFrame) -> DataFrame:
    """KPI tile texts: 'R105.5M', '4,933', '42.1%', product, Title-cased channel."""
    millions = F.round(F.col("total_revenue").cast("decimal(38,2)") / F.lit(1_000_000), 1)
    return kpi.select(
        F.concat(F.lit("R"), F.format_string("%.1f", millions.cast("double")), F.lit("M")).alias("revenue_text"),
        F.format_number(F.col("total_orders"), 0).alias("orders_text"),
        F.concat(F.format_string("%.1f", F.round(F.col("avg_margin").cast("decimal(38,10)"), 1)
                                 .cast("double")), F.lit("%")).alias("margin_text"),
        F.col("top_product").alias("product_text"),
        title_case(F.col("top_channel")).alias("channel_text"),
    )


def report_stats(trend: DataFrame, rfm: DataFrame, cohort: DataFrame, products: DataFrame,
                 channels: DataFrame, roi: DataFrame, clv: DataFrame) -> DataFrame:
    """The runner's log figures as (report, metric, value) rows."""
    def rows(report: str, df: DataFrame, **metrics: Column) -> DataFrame:
        """One aggregate over the report, one row per metric."""
        made = df.agg(*[v.cast("string").alias(m) for m, v in metrics.items()])
        return made.select(F.inline(F.array(*[
            F.struct(F.lit(report).alias("report"), F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])))

    # the product with most revenue, then by name and category
    first = F.min(F.struct(F.col("revenue").isNull().alias("null"), (-F.col("revenue")).alias("less"), "product",
                           "category", F.col("revenue").cast("decimal(38,2)").alias("revenue")))
    n = F.count(F.lit(1))
    parts = [
        rows("revenue_trend", trend, months=n, total_revenue=F.sum(F.col("net_revenue").cast("decimal(38,2)"))),
        rows("rfm_segments", rfm, segments=n, customers=F.sum("customers")),
        rows("cohort_retention", cohort, cohorts=F.countDistinct("cohort_month")),
        rows("product_performance", products, products=n, top_product=first["product"], top_revenue=first["revenue"]),
        rows("channel_performance", channels, channels=n),
        rows("marketing_roi", roi, channels=n),
        rows("segment_clv", clv, segments=n),
    ]
    return reduce(DataFrame.unionByName, parts)
