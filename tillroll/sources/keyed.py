"""A stored table that takes batches by key: checked, idempotent appends.

An append checks every row of a batch against the table's declared rules before anything is stored. A row is

* ``rejected`` with the names of the rules it breaks (NOT NULL, CHECK IN, FK; PK and UNIQUE against
  the stored rows and within the batch),
* ``present`` if an equal row is stored already, so that sending a batch again changes nothing,
* ``accepted`` and stored otherwise.

History is read only where keys may meet. Files are sorted by primary key, and the ranges in which a batch's keys
lie (a bounded number of intervals) become a pushed filter, so Parquet skips the row groups of
other keys. Key columns are compared in joins; other columns of the history are read for
rows whose key meets only.

Each append is one folder ``batch-<id>``, written under another name and renamed when
complete: readers see a batch whole or not at all, and a batch id that is stored is not written twice.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.rules import _whole_key, broken, row_rules, rule_name, same, with_orphans
from tillroll.session import remove
from tillroll.sources import schema as S

SLICES = 1024      # of a batch's key range that are looked at
RANGES = 64        # intervals of a pushed filter at most


def key_ranges(batch: DataFrame, key: str) -> list[tuple]:
    """Intervals (low, high) that hold every key of the batch, at most ``RANGES``; at most ``SLICES`` rows reach the driver.

    Whole-number keys are cut into slices of equal width, empty slices being left out; of
    the slices' intervals the closest are joined. Other keys have one interval.
    """
    k = F.col(key)
    ends = batch.agg(F.min(k).alias("lo"), F.max(k).alias("hi")).first()
    if ends["lo"] is None:
        return []
    if not isinstance(batch.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return [(ends["lo"], ends["hi"])]
    width = (ends["hi"] - ends["lo"]) // SLICES + 1
    offset = k.cast("decimal(20,0)") - F.lit(ends["lo"]).cast("decimal(20,0)")
    found = (batch.where(k.isNotNull()).groupBy(F.floor(offset / F.lit(width)).alias("s"))
             .agg(F.min(k).alias("lo"), F.max(k).alias("hi")).collect())
    spans = sorted((r["lo"], r["hi"]) for r in found)
    gaps = sorted(range(1, len(spans)), key=lambda i: spans[i][0] - spans[i - 1][1], reverse=True)[:RANGES - 1]
    out = []
    for i, (lo, hi) in enumerate(spans):
        if i == 0 or i in gaps:
            out.append([lo, hi])
        else:
            out[-1][1] = hi
    return [tuple(x) for x in out]


def within(key: str, ranges: list[tuple]) -> Column:
    """The filter that reaches the reader."""
    return reduce(or_, [F.col(key).between(lo, hi) for lo, hi in ranges]) if ranges else F.lit(False)


class KeyedTable:
    """A table of the shop stored under ``path`` (shared storage), one folder a batch."""

    def __init__(self, spark: SparkSession, path: str, table: str, schema: T.StructType | None = None, rules=None):
        self.spark, self.path, self.table = spark, path.rstrip("/"), table
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in (schema or S.TABLES[table]).fields])
        self.rules = [r[1:] for r in (rules or S.RULES) if r[0] == table]
        self.keys = [(kind, cols) for kind, cols, _ in self.rules if kind in ("pk", "unique")]

    # --- storage ------------------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> list[str]:
        """Ids of the stored batches (names of folders, not of rows)."""
        p, fs = self._fs(self.path)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(n[len("batch-"):] for n in names if n.startswith("batch-"))

    def read(self) -> DataFrame:
        """All stored rows; an empty frame before the first append."""
        if not self.batches():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch-*")

    def _commit(self, rows: DataFrame, batch_id: str) -> None:
        pk = next((cols for kind, cols in self.keys if kind == "pk"), ())
        staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
        if pk:    # a primary key occurs once, so ranges of it are even
            rows = rows.repartitionByRange(*pk).sortWithinPartitions(*pk)
        rows.write.option("compression", "zstd").parquet(staged)
        source, fs = self._fs(staged)
        target, _ = self._fs(f"{self.path}/batch-{batch_id}")
        if fs.exists(target) or not fs.rename(source, target):
            remove(self.spark, staged)
            raise FileExistsError(f"batch {batch_id} is stored already")

    # --- checking -----------------------------------------------------------------

    def _near(self, batch: DataFrame, stored: DataFrame, cols) -> DataFrame:
        """The stored rows whose first key column lies where the batch has keys."""
        return stored.where(within(cols[0], key_ranges(batch, cols[0])))

    def check(self, batch: DataFrame, parents: dict[str, DataFrame] | None = None) -> DataFrame:
        """The batch's rows with verdict, failed (array of rule names, sorted) and rows (equal rows of the batch).

        ``parents`` are the tables that fk rules refer to, without which those are not checked; for a rule that refers to
        this table itself the stored rows count, and those rows of the batch that break no rule of their own.
        Of equal rows one is judged, the others break the primary key (or are present with it).
        Of rows of the batch that share a key and break no other rule the first, in the
        order of the columns, is taken. Keys are compared after the rules of single rows.
        """
        stored = self.read()
        cols = self.schema.names
        parents = dict(parents or {})
        rows = batch.select(*[F.col(f.name).cast(f.dataType) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name)
                              for f in self.schema.fields])
        rows = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))
        rows = rows.withColumn("failed", broken(row_rules(cols, self.rules)))
        own = [(kind, c, arg) for kind, c, arg in self.rules if kind == "fk" and arg[0] == self.table]
        rows = with_orphans(rows, {k: v for k, v in parents.items() if k != self.table}, self.rules, "failed")
        for kind, c, arg in own:
            rows = self._own_parents(rows, stored, c[0], arg[1], rule_name(kind, c))

        # equal rows that are stored
        pk = next((c for kind, c in self.keys if kind == "pk"), cols[:1])
        near = self._near(batch, stored, pk).withColumn("_stored", F.lit(True))
        rows = rows.alias("b").join(near.dropDuplicates(cols).alias("s"), same("b", "s", cols), "left") \
            .select("b.*", F.col("s._stored").isNotNull().alias("_stored"))
        # keys that other stored rows hold
        for kind, c in self.keys:
            held = self._near(batch, stored, c).where(_whole_key(kind, c)).select(*[F.col(x).alias(f"_k{x}") for x in c]).distinct() \
                .withColumn("_held", F.lit(True))
            on = [F.col(x).eqNullSafe(F.col(f"_k{x}")) for x in c]
            rows = rows.join(held, reduce(lambda a, b: a & b, on), "left") \
                .withColumn("failed", F.when(F.col("_held") & ~F.col("_stored"), F.array_append("failed", F.lit(rule_name(kind, c))))
                            .otherwise(F.col("failed"))).drop("_held", *[f"_k{x}" for x in c])
        # keys that rows of the batch share: the first of those without fault keeps it, rule by rule
        for kind, c in self.keys:
            good = (F.size("failed") == 0) & ~F.col("_stored") & _whole_key(kind, c)
            first = rows.where(good).groupBy(*c).agg(F.min(F.struct(*cols)).alias("_first")) \
                .select(*[F.col(x).alias(f"_k{x}") for x in c], "_first")
            on = [F.col(x).eqNullSafe(F.col(f"_k{x}")) for x in c]
            rows = rows.join(first, reduce(lambda a, b: a & b, on) & good, "left")
            late = good & F.col("_first").isNotNull() & ~F.struct(*cols).eqNullSafe(F.col("_first"))
            rows = rows.withColumn("failed", F.when(late, F.array_append("failed", F.lit(rule_name(kind, c))))
                                   .otherwise(F.col("failed"))).drop("_first", *[f"_k{x}" for x in c])
        again = F.array(F.lit(rule_name("pk", pk)))
        ok = F.size("failed") == 0
        one, more = F.lit(1).cast("bigint"), F.col("rows") - 1
        judged = lambda v, f, n: F.struct(F.lit(v).alias("verdict"), F.array_sort(f).alias("failed"), n.alias("rows"))
        none = F.array().cast("array<string>")
        split = (F.when(F.col("_stored"), F.array(judged("present", none, F.col("rows"))))
                 .when(ok, F.array(judged("accepted", none, one), judged("rejected", again, more)))
                 .otherwise(F.array(judged("rejected", F.col("failed"), F.col("rows")))))
        return rows.select(*cols, F.inline(F.filter(split, lambda x: x["rows"] > 0)))

    def _own_parents(self, rows: DataFrame, stored: DataFrame, child: str, key: str, name: str) -> DataFrame:
        """Rows whose parent is neither stored nor a faultless row of the batch break the rule; so then do their children."""
        known = self._near(rows.select(F.col(child).alias(key)), stored, (key,)).select(F.col(key).alias("_parent"))
        while True:
            parents = known.unionByName(rows.where(F.size("failed") == 0).select(F.col(key).alias("_parent"))).distinct()
            lost = (F.size("failed") == 0) & F.col(child).isNotNull() & F.col("_parent").isNull()
            judged = rows.join(parents, F.col(child) == F.col("_parent"), "left").withColumn("_lost", lost).drop("_parent")
            judged = judged.checkpoint()          # each round reads the last one's result, not all rounds before
            if judged.where("_lost").isEmpty():
                return judged.drop("_lost")
            rows = judged.withColumn("failed", F.when(F.col("_lost"), F.array_append("failed", F.lit(name)))
                                     .otherwise(F.col("failed"))).drop("_lost")

    def append(self, batch: DataFrame, parents: dict[str, DataFrame] | None = None, batch_id: str | None = None,
               report: str | None = None) -> DataFrame:
        """Check the batch, store its accepted rows as one folder, and give back the verdicts.

        The verdicts are written to ``report`` (a folder beside the table if not given), so that they are those that were acted upon.
        """
        batch_id = batch_id or uuid.uuid4().hex
        if not re.fullmatch(r"[\w.-]+", batch_id):
            raise ValueError("a batch id has letters, digits, '_', '.' and '-'")
        report = report or f"{self.path}/_verdicts-{batch_id}-{uuid.uuid4().hex[:8]}"
        if batch_id in self.batches():
            raise FileExistsError(f"batch {batch_id} is stored already")
        self.check(batch, parents).write.mode("overwrite").option("compression", "zstd").parquet(report)
        verdicts = self.spark.read.parquet(report)
        accepted = verdicts.where("verdict = 'accepted'").select(*self.schema.names)
        if not accepted.isEmpty():
            self._commit(accepted, batch_id)
        return verdicts
