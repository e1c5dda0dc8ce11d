"""Quality classifier: a byte-level convolutional network over overlapping chunks.

Chunks of 256 bytes, 32 of them shared with the next, cover the whole document; learned
filters are max-pooled over each chunk, and the chunks' logits are averaged
into one probability.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_bytes
from tillroll.llm.convnet import ByteConvNet
from tillroll.llm.langid import remainder
from tillroll.llm.textnet import apply_net, at_most, balanced, learn_sample, sample_windows

SIZE, STEP = 256, 224
WIDTHS = {3: 8, 6: 16}


def fit(docs: DataFrame, labels: DataFrame, usable, key: str = "doc_id", text: str = "text",
        label: str = "quality", per_label: int = 2000, per_text: int = 8) -> ByteConvNet | None:
    """Learn from at most ``per_label`` labelled documents of each label (the sample's bound), ``per_text`` chunks of each.

    Only labels 0 and 1 of non-null keys count; a key with several rows has the
    smallest of its labels. Documents are drawn by key and text, however many rows share a key. None if a label is missing.
    """
    marks = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & usable)
             .groupBy(F.col(key).alias("id")).agg(F.min(label).cast("int").alias("label")))
    taken = learn_sample(marks, per_label, ["id"])
    # bounded by 2 * per_label keys, so the documents are not shuffled for it
    rows = (docs.select(F.col(key).alias("id"), text_bytes(F.col(text)).alias("body"))
            .join(F.broadcast(taken), "id").select("id", "label", "body"))
    rows = at_most(rows, per_label, F.xxhash64("id", "body"))      # one key may have any number of documents
    x, y = sample_windows(rows, SIZE, STEP, per_text, lower=False)
    y = np.array(y, np.int64)
    if len(set(y.tolist())) < 2:
        return None
    return ByteConvNet(WIDTHS, 2).fit(x, y, balanced(y), epochs=12)


def score(docs: DataFrame, net: ByteConvNet | None, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with ``score`` (0 to 1) and ``predicted``; an empty or null text scores 0.5 without evidence."""
    if net is None:
        return docs.select(*keep, F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))

    def finish(texts: list[bytes], z: np.ndarray) -> dict:
        p = 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -60, 60)))
        return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}

    return apply_net(docs, net, finish, "score double, predicted int", SIZE, STEP, False, text, keep)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
             folds: int = 3, held_out: int = 1) -> DataFrame:
    """Per row: key, held_out, score, predicted; labels of the held-out fold are never read.

    Keys, languages, sources and labels are no inputs of a score. Null keys are scored like
    others, repeated rows alike; an empty table gives none.
    """
    net = fit(docs, labels, remainder(key, folds) != held_out, key, text, label)
    out = score(docs, net, [key], text)
    return out.select(key, (remainder(key, folds) == held_out).alias("held_out"), "score", "predicted")
