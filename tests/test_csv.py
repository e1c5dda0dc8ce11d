"""CSV: a lossless round trip, agreement with Python's csv module and pandas, and malformed records."""

from __future__ import annotations

import csv
import datetime as dt
import glob
import random
from decimal import Decimal as D

import pandas as pd
import pytest
from pyspark.sql import types as T

from tillroll.sources import sinks

NAMES = ["plain", 'say "hi"', "a,b", "line\nbreak", "", " pad ", None, "cr\rlf\r\nend", "\\", 'back\\"slash', "#note", '"', '""', "é x",
         "\ttab\t", "NULL", "\\N", "a\x00b", "﻿bom", "'", "  ", "\n", ","]
SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("price", T.DecimalType(18, 2)),
    T.StructField("ratio", T.DoubleType()), T.StructField("day", T.DateType()), T.StructField("at", T.TimestampNTZType()),
    T.StructField("ok", T.BooleanType()), T.StructField("note", T.StringType())])


def rows():
    rng = random.Random(1)
    out = [(i, n, D(i) / 100, i / 7, dt.date(2024, 1, 1 + i), dt.datetime(2024, 1, 1, 0, 0, i, 123456 + i), i % 2 == 0, rng.choice(NAMES))
           for i, n in enumerate(NAMES)]
    return out + [(None,) * 8, (99, "x", D("-0.01"), 1e300, None, None, None, "")]


def test_round_trip_is_lossless(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA)
    df.write.parquet(str(tmp_path / "truth"))
    sinks.export_csv(df.repartition(3), str(tmp_path / "csv"))
    back = sinks.import_csv(spark, str(tmp_path / "csv"), SCHEMA)
    truth = spark.read.parquet(str(tmp_path / "truth"))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, truth.collect()), key=repr)


def test_other_readers_agree(spark, tmp_path):
    sinks.export_csv(spark.createDataFrame(rows(), SCHEMA).coalesce(1), str(tmp_path / "csv"))
    (file,) = glob.glob(str(tmp_path / "csv" / "*.csv"))
    with open(file, newline="", encoding="utf-8") as f:
        got = list(csv.reader(f))
    assert got[0] == SCHEMA.names
    assert [r[1] for r in got[1:]] == [n or "" for n in [*NAMES, None, "x"]]
    frame = pd.read_csv(file, keep_default_na=False, dtype=str, lineterminator="\n")
    # pandas' reader ends a text at a NUL
    assert frame["name"].tolist() == [(n or "").split("\0")[0] for n in [*NAMES, None, "x"]]


def test_files_of_pandas_are_read(spark, tmp_path):
    frame = pd.DataFrame({"id": range(7), "name": ["a", 'q"q', "x,y", "l\nb", " pad ", "", None]})
    frame.to_csv(tmp_path / "p.csv", index=False)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    got = [r.name for r in sinks.import_csv(spark, str(tmp_path / "p.csv"), schema).orderBy("id").collect()]
    assert got[:5] == ["a", 'q"q', "x,y", "l\nb", " pad "] and got[6] is None


def test_one_column(spark, tmp_path):
    one = T.StructType([T.StructField("name", T.StringType())])
    df = spark.createDataFrame([(n,) for n in NAMES if n is not None], one)
    sinks.export_csv(df, str(tmp_path / "one"))
    back = sinks.import_csv(spark, str(tmp_path / "one"), one)
    assert sorted(r.name for r in back.collect()) == sorted(n for n in NAMES if n is not None)
    with pytest.raises(Exception, match="would be lost"):
        sinks.export_csv(spark.createDataFrame([(None,)], one), str(tmp_path / "two"))


def test_every_record_is_good_or_malformed(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType(), True),
                           T.StructField("qty", T.IntegerType(), True)])
    good = ['1,a,1', '2,"two\nlines",2', '3,,', '4,"q""q",4', '5,"",5']
    bad = ['x,a,1', '6,a', '7,a,1,9', '8,a,many', ',no id,1', '9']
    (tmp_path / "in.csv").write_text("id,name,qty\n" + "\n".join(x for pair in zip(good, bad) for x in pair) + "\n" + bad[5] + "\n")
    ok, wrong = sinks.read_records(spark, str(tmp_path / "in.csv"), schema)
    assert sorted(map(tuple, ok.collect())) == [(1, "a", 1), (2, "two\nlines", 2), (3, None, None), (4, 'q"q', 4), (5, "", 5)]
    assert sorted(r.record for r in wrong.collect()) == sorted(bad)
    assert ok.select("name").count() == 5 and wrong.select("reason").count() == 6    # whichever columns are read
    counts = {r.outcome: r.rows for r in sinks.import_records(
        spark, str(tmp_path / "in.csv"), schema, str(tmp_path / "good"), str(tmp_path / "bad")).collect()}
    assert counts == {"good": 5, "malformed": 5, "empty: id": 1}


def test_broken_file_is_an_error_for_exports(spark, tmp_path):
    (tmp_path / "in.csv").write_text("id,name\n1,a\nx,b\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    with pytest.raises(Exception, match="Malformed|MALFORMED"):
        sinks.import_csv(spark, str(tmp_path / "in.csv"), schema).collect()


@pytest.mark.parametrize("fmt", ["csv"])
def test_load_tables_reads_csv_of_shop_tables(spark, tmp_path, fmt):
    from tillroll.sources.tables import load_tables
    from tillroll.sources import schema as S
    cat = spark.createDataFrame([(1, 'Phones, "smart"', None), (2, "line\nbreak", 1)], S.CATEGORIES)
    for name, st in S.TABLES.items():
        df = cat if name == "categories" else spark.createDataFrame([], st)
        sinks.export_csv(df, str(tmp_path / name))
    got = load_tables(spark, str(tmp_path), fmt)["categories"].orderBy("category_id").collect()
    assert [tuple(r) for r in got] == [(1, 'Phones, "smart"', None), (2, "line\nbreak", 1)]
