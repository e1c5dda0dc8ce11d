"""Helpers shared by the operators: scratch tables, word bytes, Arrow batches.

A *word* is a maximal run of characters other than space and U+0009..U+000D.
In UTF-8 these separators are single bytes that occur in no other character,
so ``bytes.split()`` gives exactly those words without decoding the text.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOCAL: dict[str, str] = {}   # temporary folders of local applications that name none


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local master, as in tests, may go without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    sc = spark.sparkContext
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if sc.applicationId not in _LOCAL:
        _LOCAL[sc.applicationId] = tempfile.mkdtemp(prefix="tillroll-llm-")
    return _LOCAL[sc.applicationId]


class Scratch:
    """Written tables that cut lineage, in the shared folder.

    ``save`` runs a plan once and gives back a scan of its result, so that a
    lost executor costs a re-read and not a re-run. ``drop`` removes tables
    no later step reads; the rest goes when the application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def _path(self, where: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def save(self, df: DataFrame) -> DataFrame:
        where = f"{shared_folder(self.spark)}/scratch-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(where)
        path, fs = self._path(where)
        fs.deleteOnExit(path)
        out = self.spark.read.schema(df.schema).parquet(where)
        self.paths[id(out)] = where
        out._scratch_path = where
        return out

    def save_bucketed(self, df: DataFrame, by: str) -> DataFrame:
        """As ``save``, in as many buckets of the column ``by`` as shuffles have partitions: grouping by it moves no row."""
        name = f"tillroll_scratch_{uuid.uuid4().hex}"
        where = f"{shared_folder(self.spark)}/{name}"
        (df.write.option("compression", "zstd").format("parquet").option("path", where)
         .bucketBy(int(self.spark.conf.get("spark.sql.shuffle.partitions")), by).saveAsTable(name))
        path, fs = self._path(where)
        fs.deleteOnExit(path)
        out = self.spark.table(name)
        out._scratch_path = where
        self.spark.sql(f"DROP TABLE {name}")       # only the name: the files stay, and the frame knows them
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path, fs = self._path(t._scratch_path)
            fs.delete(path, True)


ROWS = 256           # of an Arrow batch, as many as are worked on and sent back at once
SLICE = 4 << 20      # bytes of texts that are worked on together where a column's size decides


def _slices(batch: pa.RecordBatch, rows: int, sized: int | None, size: int) -> Iterator[pa.RecordBatch]:
    if sized is None:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        return
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(sized)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        n = max(1, int(np.searchsorted(ends, before + size, "right")) - at)
        yield batch.slice(at, n)
        at += n


def map_arrow(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], dict], rows: int = ROWS,
              sized: int | None = None, size: int = SLICE) -> DataFrame:
    """One dict of columns (arrays or lists) out for each slice of an Arrow batch, so that long texts do not pile up.

    A slice has ``rows`` rows, or with ``sized`` (a column's number) as many as hold ``size`` bytes there, one at least.
    """
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, part in enumerate(_slices(batch, rows, sized, size)):
                if i:
                    pa.default_memory_pool().release_unused()
                cols = fn(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[f.name], type=f.type, from_pandas=False)
                     if not isinstance(cols[f.name], (pa.Array, pa.ChunkedArray)) else cols[f.name].cast(f.type)
                     for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each changed where ``df`` has a column called so (case ignored)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def text_bytes(col) -> "F.Column":
    """The text as binary, so that Python gets its bytes undecoded; null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("binary")


def text_hash(col) -> "F.Column":
    """128 bits of the whole text as binary; null as empty. One key may hold any share of the rows, so texts
    of one key must not meet by chance: among 1e12 of them two do with a chance of about 1e-15."""
    return F.unhex(F.md5(text_bytes(col)))


def row_key(key: str, text: str) -> list:
    """Columns ``k`` and ``th`` that tell rows apart by key and text, null keys included."""
    return [F.coalesce(F.concat(F.lit("k"), F.col(f"`{key}`").cast("string")), F.lit("n")).alias("k"),
            text_hash(F.col(f"`{text}`")).alias("th")]


# The order and the spread of a sum of products need well mixed 64-bit values.
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


class WindowHash:
    """Hashes of all runs of a sequence of 64-bit word hashes, from one prefix sum.

    The hash of words ``i..i+n`` is ``sum(word[i+j] * base**j) mod 2**64``: with
    an odd base it has an inverse, so a difference of prefix sums gives it.
    """

    def __init__(self, base: int = 0x9E3779B97F4A7C15):
        self.base = np.uint64(base | 1)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        def powers(b):
            a = np.full(n, b, np.uint64)
            a[0] = 1
            return np.multiply.accumulate(a)
        self.up, self.down = powers(self.base), powers(self.inverse)

    def prefix(self, words: np.ndarray) -> np.ndarray:
        n = len(words) + 1
        if n > len(self.up):
            self._grow(max(n, 2 * len(self.up)))
        out = np.zeros(n, np.uint64)
        np.cumsum(words * self.up[:n - 1], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefix[end] - prefix[start]) * self.down[start]

    def windows(self, prefix: np.ndarray, n: int) -> np.ndarray:
        """Of every run of ``n`` words."""
        m = max(0, len(prefix) - n)
        return (prefix[n:] - prefix[:m]) * self.down[:m]
