"""Fit a :class:`ByteConvNet` on a bounded sample and apply it to whole texts (shared by two operators)."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillroll.llm.common import fresh, map_arrow, text_bytes
from tillroll.llm.convnet import ByteConvNet, cut


MOST_LABELS = 256     # labels that are learned: the most frequent


def at_most(rows: DataFrame, per_label: int, u) -> DataFrame:
    """The ``per_label`` rows of each label with the smallest ``u``; ties are cut too, so equal rows cannot exceed it.

    Every task keeps its own first rows of a label before anything is shuffled.
    """
    order = W.partitionBy("label").orderBy("_u")
    return rows.withColumn("_u", u).withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= per_label).drop("_u", "_at")


def learn_sample(rows: DataFrame, per_label: int, by: list[str]) -> DataFrame:
    """At most ``per_label`` rows of each of at most ``MOST_LABELS`` labels, drawn by a hash of the columns ``by``.

    The bound is exact: rows alike in ``by``, which share a hash, count one by one. If there are
    many labels each gets fewer rows, so that the sample has at most 16 * per_label in all. Of the table only the counts of these labels reach the driver.
    """
    u = F.pmod(F.xxhash64(*[F.col(c) for c in by], F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # rows alike count once here, or one frequent row could leave its label without any
    counted = (rows.groupBy("label").agg(F.approx_count_distinct(u).alias("n"), F.count("*").alias("rows"))
               .orderBy(F.col("rows").desc(), "label").limit(MOST_LABELS).collect())
    per_label = min(per_label, max(1, 16 * per_label // max(1, len(counted))))
    share = F.lit(0.0)
    for r in counted:   # more than needed passes, and the bound is applied to that
        share = F.when(F.col("label") == r["label"], F.lit(min(1.0, (1.3 * per_label + 50) / r["n"]))).otherwise(share)
    return at_most(rows.where(u < share), per_label, u)


def sample_windows(rows: DataFrame, size: int, step: int, per_text: int, lower: bool) -> tuple[np.ndarray, list]:
    """(windows, labels) of rows (id, label, body): up to ``per_text`` windows from anywhere in each text."""
    kind = rows.schema["label"].dataType.simpleString()

    def draw(batch: pa.RecordBatch) -> dict:
        out, of = [], []
        for i, (key, body) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
            x, _ = cut([body.lower() if lower else body], size, step)
            rng = np.random.default_rng(zlib.crc32(str(key).encode()))
            for j in rng.permutation(len(x))[:per_text]:
                out.append(x[j].tobytes())
                of.append(i)
        return {"id": batch.column(0).take(pa.array(of, pa.int64())), "label": batch.column(1).take(pa.array(of, pa.int64())), "x": out}

    key = rows.schema["id"].dataType.simpleString()
    got = map_arrow(rows.select("id", "label", "body"), f"id {key}, label {kind}, x binary", draw).collect()
    got = sorted(((r["id"], r["label"], bytes(r["x"])) for r in got), key=lambda r: (str(r[0]), str(r[1]), r[2]))
    x = np.frombuffer(b"".join(r[2] for r in got), np.uint8).reshape(-1, size)
    return x, [r[1] for r in got]


def balanced(y: np.ndarray) -> np.ndarray:
    """Weights that give every class the same total."""
    n = np.bincount(y)
    return (len(y) / np.maximum(n, 1) / max(1, (n > 0).sum()))[y]


def apply_net(docs: DataFrame, net: ByteConvNet, finish, schema: str, size: int, step: int,
              lower: bool, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` and those ``finish(texts, mean logits)`` gives.

    The network's few tables (well under 1 MB, whatever the data) travel with the tasks.
    """
    # a kept text is not sent a second time
    body = text if text in keep else fresh(docs, "body")[0]
    src = docs.select(*[F.col(f"`{c}`") for c in keep],
                      *([] if body == text else [text_bytes(F.col(f"`{text}`")).alias(body)]))
    at = src.columns.index(body)
    kinds = "".join(f"`{c}` {src.schema[c].dataType.simpleString()}, " for c in keep)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batch: pa.RecordBatch) -> dict:
        raw = [b or b"" for b in batch.column(at).cast(pa.binary()).to_pylist()]
        z = shared.value.mean_logits([b.lower() for b in raw] if lower else raw, size, step)
        return {c: batch.column(i) for i, c in enumerate(keep)} | finish(raw, z)

    return map_arrow(src, kinds + schema, run)
