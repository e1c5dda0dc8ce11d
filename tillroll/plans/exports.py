"""The runner: every export report to CSV and the KPI row to JSON, in one call.

    python -m tillroll.plans.exports <tables> <out_dir> [--native]

``<tables>`` is a folder of the driver's star-schema Parquet files, or with
``--native`` a folder of the six shop tables. Each report is written by
Spark's parallel CSV writer to ``<out_dir>/<report>/`` (header row, replacing
earlier output) and the KPI summary to ``<out_dir>/summary/`` as JSON. The
returned frame holds the runner's log figures (``report_stats``).
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import shape
from tillroll.operators.facts import with_order_grain
from tillroll.plans import channel, clv, cohort, marketing, product, revenue, rfm
from tillroll.session import ensure_checkpoint_dir, remove
from tillroll.sources import sinks
from tillroll.sources.tables import Shop, load_shop, star_tables

# File names of the exports (fixed values of the runner's output layout).
EXPORTS = {
    "revenue_trend": revenue.revenue_trend_export,
    "rfm_segments": rfm.rfm_segments_export,
    "cohort_retention": cohort.cohort_retention_export,
    "product_performance": product.product_performance_export,
    "channel_performance": channel.channel_performance_export,
    "marketing_roi": marketing.marketing_roi_export,
    "segment_clv": clv.segment_clv_export,
}


def export_all(shop: Shop, out_dir: str) -> DataFrame:
    """Write the seven exports and the KPI summary; return the log figures.

    The reports share one order grain, written beside the exports for the time of the run: lines are
    summed once for the five reports that count orders (products need their own grain).
    """
    spark = shop.orders.sparkSession
    scratch = f"{out_dir}/_order_grain"
    frames = {}
    try:
        shop = with_order_grain(shop, scratch)
        for name, fn in EXPORTS.items():   # each report runs once; what follows reads the files
            df = fn(shop)
            sinks.export_csv(df, f"{out_dir}/{name}")
            frames[name] = sinks.import_csv(spark, f"{out_dir}/{name}", df.schema)
    finally:
        remove(spark, scratch)
    summary = shape.kpi_summary(frames["revenue_trend"], frames["product_performance"],
                                frames["channel_performance"])
    sinks.export_json(summary, f"{out_dir}/summary")
    return shape.report_stats(frames["revenue_trend"], frames["rfm_segments"],
                              frames["cohort_retention"], frames["product_performance"],
                              frames["channel_performance"], frames["marketing_roi"],
                              frames["segment_clv"])


def main(argv: list[str]) -> int:
    if len(argv) < 2:
        print(__doc__)
        return 2
    spark = (SparkSession.builder.appName("tillroll-exports")
             .config("spark.ui.enabled", "false").getOrCreate())
    ensure_checkpoint_dir(spark)
    shop = load_shop(spark, argv[0]) if "--native" in argv else star_tables(spark, argv[0])
    for row in export_all(shop, argv[1]).collect():   # eleven log lines
        print(f"{row.report}: {row.metric} = {row.value}")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
