"""Replacing a warehouse table: old rows stay until the new ones are all there."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from tillroll.sources import sinks


@pytest.fixture
def table(spark):
    name = f"wh_{uuid.uuid4().hex[:10]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_replaces_rows(spark, table, tmp_path):
    root = str(tmp_path / "t")
    assert ids(sinks.load_warehouse_table(spark.range(3), table, root)) == [0, 1, 2]
    early = spark.table(table)                                    # a reader that began before the load
    assert ids(sinks.load_warehouse_table(spark.range(10, 12), table, root)) == [10, 11]
    assert ids(early) == [0, 1, 2]
    assert ids(sinks.load_warehouse_table(spark.range(0), table, root)) == []
    assert len(sinks._versions(spark, root)) == 2                 # this one and the one before


def test_a_write_that_fails_leaves_the_old_rows(spark, table, tmp_path):
    root = str(tmp_path / "t")
    sinks.load_warehouse_table(spark.range(100), table, root)
    half = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") < 700, F.col("id")).otherwise(
        F.raise_error(F.lit("lost its source")).cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="lost its source"):
        sinks.load_warehouse_table(half, table, root)
    assert ids(spark.table(table)) == list(range(100))
    assert ids(sinks.load_warehouse_table(spark.range(5), table, root)) == list(range(5))


def test_rows_can_be_read_until_the_entry_changes(spark, table, tmp_path, monkeypatch):
    root, seen = str(tmp_path / "t"), []
    sinks.load_warehouse_table(spark.range(4), table, root)
    write = sinks._write_version

    def looking(df, version):
        seen.append(ids(spark.table(table)))
        write(df, version)
        seen.append(ids(spark.table(table)))

    monkeypatch.setattr(sinks, "_write_version", looking)
    sinks.load_warehouse_table(spark.range(7, 9), table, root)
    assert seen == [[0, 1, 2, 3]] * 2 and ids(spark.table(table)) == [7, 8]


def test_a_table_may_feed_its_own_replacement(spark, table, tmp_path):
    root = str(tmp_path / "t")
    sinks.load_warehouse_table(spark.range(6), table, root)
    sinks.load_warehouse_table(spark.table(table).where("id > 2"), table, root)
    assert ids(spark.table(table)) == [3, 4, 5]


def test_other_columns_are_refused(spark, table, tmp_path):
    root = str(tmp_path / "t")
    sinks.load_warehouse_table(spark.range(3), table, root)
    other = spark.range(2).select(F.col("id").cast("string").alias("name"))
    with pytest.raises(ValueError, match="other columns"):
        sinks.load_warehouse_table(other, table, root)
    assert ids(spark.table(table)) == [0, 1, 2]
    assert sinks.load_warehouse_table(other, table, root, new_schema=True).columns == ["name"]


def test_without_a_path_versions_lie_in_the_warehouse(spark, table):
    sinks.load_warehouse_table(spark.range(3), table)
    assert ids(sinks.load_warehouse_table(spark.range(2), table)) == [0, 1]
    root = f"{spark.conf.get('spark.sql.warehouse.dir')}/{table}.versions"
    assert len(sinks._versions(spark, root)) == 2
