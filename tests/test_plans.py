"""Physical plan properties the scale design relies on."""

from __future__ import annotations

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, key: str) -> str:
    df = E.queries()[key](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_expand_for_distinct_counts(spark):
    for key in ("revenue_trend", "channel_quality", "marketing_roi", "segment_clv"):
        assert "Expand" not in _plan(spark, key), key


def test_rows_never_meet_in_one_partition(spark):
    # only results with one row per month / label may use an unpartitioned window
    for key in ("product_pareto", "customer_rfm_scores", "product_performance_export"):
        plan = _plan(spark, key)
        assert "SinglePartition" not in plan, key


def test_scan_prunes_columns(spark):
    plan = _plan(spark, "revenue_trend")
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans
    for s in scans:
        schema = s[s.index("ReadSchema"):]
        assert "l_comment" not in schema and "l_tax" not in schema and "l_returnflag" not in schema


def test_native_status_filter_reaches_parquet(spark, tmp_path):
    from tillroll.plans import revenue
    from tillroll.sources.tables import load_shop
    from tillroll.sources.synth import synth_shop, synth_tables
    shop = synth_shop(spark, n_customers=50)
    root = str(tmp_path / "shop")
    for name, df in synth_tables(shop).items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    native = load_shop(spark, root)
    plan = revenue.revenue_trend(native)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,completed)" in plan
    assert revenue.revenue_trend(native).count() > 0


def test_adapter_completed_filter_reaches_parquet(spark):
    plan = _plan(spark, "revenue_trend")
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "orders.parquet" in line]
    assert any("EqualNullSafe(o_orderstatus,F)" in s for s in scans), scans


def test_rfm_reads_no_attributes_and_shuffles_no_customer_for_its_tiles(spark):
    from tillroll.plans import rfm
    from tillroll.sources.tables import star_tables
    shop = star_tables(spark, SF)
    numbers = rfm.rfm_numbers(shop)._jdf.queryExecution().executedPlan().toString()
    for table in ("nation", "region", "events"):
        assert f"{table}.parquet" not in numbers, table
    tiles = rfm.customer_rfm_labels_exact(shop)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in tiles and "Window" not in tiles


def test_adapter_scans_are_not_dealt_out(spark):
    for key in ("revenue_trend", "channel_quality", "segment_clv", "cohort_retention"):
        assert "RoundRobinPartitioning" not in _plan(spark, key), key
    for key in ("marketing_roi", "segment_clv"):
        assert "nation.parquet" not in _plan(spark, key), key


def test_row_rules_share_one_scan_of_a_table(spark):
    plan = _plan(spark, "constraint_violations")
    lines = [x for x in plan.splitlines() if "FileScan parquet" in x and "lineitem.parquet" in x]
    assert len(lines) <= 4   # row rules, key, and one for each of two foreign keys
