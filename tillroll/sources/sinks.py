"""Sinks and their readers: CSV and JSON exports, warehouse table load.

Writers are Spark's parallel writers (one file per partition, no driver
collect). Paths must be shared storage on a cluster; :func:`shared_path`
places scratch output under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.session import checkpoint_dir, remove


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared ``spark.checkpoint.dir``."""
    root = checkpoint_dir(spark)
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set; pass an explicit shared path")
    return f"{root.rstrip('/')}/exports/{name}-{uuid.uuid4().hex[:12]}"


# One dialect for writing and reading: quotes are doubled inside quotes, as pandas and Python's csv module write and
# read them; nothing is trimmed; NULL is an empty field and the empty text a quoted one. Fractions of
# a second keep their six digits.
_CSV = {
    "header": True, "sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8", "lineSep": "\n",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_CSV_WRITE = {**_CSV, "nullValue": "", "emptyValue": '""'}
# a quoted field may hold line breaks, so a file is read by one task: writers make files of bounded size
_CSV_READ = {**_CSV, "emptyValue": "", "multiLine": True, "mode": "FAILFAST"}
ROWS_PER_FILE = 5_000_000


def _csv_read() -> dict:
    """Reading options. The parser hands on an empty unquoted field as its null value: a name that no text has."""
    return {**_CSV_READ, "nullValue": uuid.uuid4().hex}


def export_csv(df: DataFrame, path: str) -> None:
    """Write with a header row, replacing earlier output (``to_csv(index=False)``).

    Every value comes back from :func:`import_csv` as it was: quotes, commas, line breaks of any kind, space at the
    ends, empty text and NULL. A frame of one text column may hold no NULL: its line would be blank, and blank lines are no rows.
    """
    if len(df.columns) == 1 and isinstance(df.schema[0].dataType, StringType) and df.schema[0].nullable:
        df = df.select(F.coalesce(F.col(df.columns[0]), F.raise_error(F.lit("a NULL in a CSV file of one text column would be lost")))
                       .alias(df.columns[0]))
    df.write.mode("overwrite").options(**_CSV_WRITE, maxRecordsPerFile=ROWS_PER_FILE).csv(path)


def import_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read an export back with a declared schema (no inference pass); a malformed record is an error.

    Files of unknown quality are read by :func:`read_records`.
    """
    return spark.read.schema(schema).options(**_csv_read()).csv(path)


RECORD = "_record"


def read_records(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed records) of CSV files of unknown quality; every record is in exactly one of the two.

    A record is malformed if it has more or fewer fields than the schema, if a value is not of its
    column's type, or if a column that the schema declares NOT NULL is empty. Good rows have the schema's columns,
    malformed records file, record (the text as it stands) and reason. Blank lines are no records.
    """
    nullable = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
    options = {**_csv_read(), "header": header, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD,
               "enforceSchema": True}
    raw = spark.read.schema(StructType([*nullable.fields, StructField(RECORD, StringType(), True)])).options(**options).csv(path) \
        .withColumn("_file", F.input_file_name())
    empty = F.array_compact(F.array(*[F.when(F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable],
                                    F.lit(None).cast("string")))
    # always true; but as it names every column none is pruned, so a record is judged by all, whichever are asked for
    whole = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in schema.names]), F.lit(2)) < 2
    judged = raw.where(whole).withColumn("_empty", empty)
    bad = F.col(RECORD).isNotNull() | (F.size("_empty") > 0)
    good = judged.where(~bad).select(*[F.col(f"`{c}`") for c in schema.names])
    written = F.concat_ws(",", *[F.coalesce(_csv_field(F.col(f"`{f.name}`"), f.dataType), F.lit("")) for f in schema.fields])
    reason = F.when(F.col(RECORD).isNotNull(), F.lit("malformed")).otherwise(
        F.concat(F.lit("empty: "), F.array_join("_empty", ",")))
    return good, judged.where(bad).select(F.col("_file").alias("file"), F.coalesce(RECORD, written).alias("record"),
                                          reason.alias("reason"))


def _csv_field(c: Column, kind) -> Column:
    """A value as a CSV field."""
    text = c.cast("string")
    if not isinstance(kind, StringType):
        return text
    return F.when(text.rlike('[",\\r\\n]') | (text == ""), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))) \
        .otherwise(text)


def import_records(spark: SparkSession, path: str, schema: StructType, good_path: str, quarantine_path: str) -> DataFrame:
    """Read CSV files, store good rows and quarantined records as Parquet; returns (outcome, rows) of both.

    The counts are of what was stored, so that they add up to the records that were read.
    """
    good, bad = read_records(spark, path, schema)
    good.write.mode("overwrite").parquet(good_path)
    bad.write.mode("overwrite").parquet(quarantine_path)
    return spark.read.schema(good.schema).parquet(good_path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("good").alias("outcome"), "rows") \
        .unionByName(spark.read.schema(bad.schema).parquet(quarantine_path).groupBy(F.col("reason").alias("outcome"))
                     .agg(F.count(F.lit(1)).alias("rows")))


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines, replacing earlier output."""
    df.write.mode("overwrite").json(path)


def import_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def load_warehouse_table(df: DataFrame, table: str, path: str | None = None, new_schema: bool = False) -> DataFrame:
    """Replace a table's contents (WRITE_TRUNCATE) and return the table.

    The rows are written to a folder of their own first; when all are there the catalog's entry is
    pointed at it in one change. A write that fails half-way leaves the old rows as they were, and readers
    see the old rows or the new ones, never none. The version before stays on disk for
    queries that still read it and goes with the next load.

    Versions lie under ``path`` (shared storage), else beside the warehouse's tables. A frame of other columns than
    the table's is refused unless ``new_schema``: the entry is made anew then, which is not one change.
    """
    spark = df.sparkSession
    root = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{table.replace('.', '/')}.versions").rstrip("/")
    exists = spark.catalog.tableExists(table)
    if exists and _shape(spark.table(table).schema) != _shape(df.schema) and not new_schema:
        raise ValueError(f"{table} has other columns; pass new_schema=True to make it anew")
    version = f"{root}/version-{uuid.uuid4().hex}"
    before = _location(spark, table) if exists else None
    _write_version(df, version)
    if exists and new_schema:
        spark.sql(f"DROP TABLE {table}")       # of an external table: the files stay
    if exists and not new_schema:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=version, source="parquet", schema=spark.read.parquet(version).schema)
    for old in _versions(spark, root):
        if old not in (version.rsplit("/", 1)[1], (before or "").rsplit("/", 1)[-1]):
            remove(spark, f"{root}/{old}")
    return spark.table(table)


def _write_version(df: DataFrame, version: str) -> None:
    df.write.mode("errorifexists").parquet(version)


def _shape(schema: StructType) -> list:
    return [(f.name, f.dataType) for f in schema.fields]


def _location(spark: SparkSession, table: str) -> str:
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return row["data_type"].rstrip("/") if row else ""


def _versions(spark: SparkSession, root: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("version-")]


def save_tables(tables: dict[str, DataFrame], path: str, mode: str = "overwrite",
                fmt: str = "parquet") -> None:
    """Write every table to ``path/<name>``: ``overwrite`` drops and recreates,
    ``append`` is a bulk insert."""
    for name, df in tables.items():
        df.write.mode(mode).format(fmt).save(f"{path}/{name}")
