"""SimHash near-duplicates, linked through the anchors of a covering code.

The anchors are the codewords of the Hamming code on bits 0..62 with bit 63
free: a perfect code of covering radius 1, so every 64-bit value has an anchor
at 1 bit or less. Two fingerprints at ``d`` bits or less have a value in the
middle, ``ceil(d / 2)`` bits or less from both. Each fingerprint is replicated
to the anchor of every value within ``ceil(d / 2)`` of it, all of which lie within
the covering radius plus the threshold, so both meet at the anchor of that
middle value: no link is lost. An anchor's bucket holds different
fingerprints within ``1 + ceil(d / 2)`` bits of it, hence at most 2081 of them for
``d <= 2`` however the data are skewed; a bucket yields links to the smallest
member of each of its local components, never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import Scratch, fresh, map_arrow, row_key, text_bytes

SEED = 42
BLOCK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a text's shingles of ``shingle`` words, repeats included."""
    words = text.lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    h = np.fromiter(map(lambda g: xxhash.xxh64_intdigest(g, SEED), grams), np.uint64,
                    max(1, len(words) - shingle + 1))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), BLOCK):
        bits = np.unpackbits(h[i:i + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` without its text, with a signed 64-bit fingerprint; null text: none, so zero."""
    rest = [c for c in docs.columns if c != text]
    body, = fresh(docs, "body")
    src = docs.select(*[F.col(f"`{c}`") for c in rest], text_bytes(F.col(f"`{text}`")).alias(body))
    schema = ", ".join([f"`{c}` {src.schema[c].dataType.simpleString()}" for c in rest] + [f"`{out}` bigint"])

    def run(batch: pa.RecordBatch) -> dict:
        fp = np.array([fingerprint(b, shingle) for b in batch.column(len(rest)).to_pylist()], np.uint64)
        return {c: batch.column(i) for i, c in enumerate(rest)} | {out: fp.view(np.int64)}

    return map_arrow(src, schema, run)


def _syndrome(x: np.ndarray) -> np.ndarray:
    """Of the Hamming code on bits 0..62: the number of the bit to flip, 0 for a codeword."""
    s = np.zeros(len(x), np.uint64)
    for k in range(6):
        mask = np.uint64(sum(1 << (i - 1) for i in range(1, 64) if i >> k & 1))
        s |= (np.bitwise_count(x & mask).astype(np.uint64) & np.uint64(1)) << np.uint64(k)
    return s


def nearest_anchor(x: np.ndarray) -> np.ndarray:
    s = _syndrome(x)
    return np.where(s == 0, x, x ^ (np.uint64(1) << (np.maximum(s, np.uint64(1)) - np.uint64(1))))


def anchors(x: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into x, anchor) pairs: the anchors of all values within half the distance."""
    flips = [0]
    for n in range(1, (distance + 1) // 2 + 1):
        flips += [sum(1 << b for b in c) for c in combinations(range(64), n)]
    flips = np.array(flips, np.uint64)
    at = np.sort(nearest_anchor((x[:, None] ^ flips[None, :]).ravel()).reshape(len(x), -1), axis=1)
    new = np.ones(at.shape, bool)
    new[:, 1:] = at[:, 1:] != at[:, :-1]
    return np.nonzero(new)[0], at[new]


def _local_roots(x: np.ndarray, distance: int) -> np.ndarray:
    """For each of a bucket's fingerprints, the smallest one its local component holds."""
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= distance
    label = np.arange(len(x))
    order = np.argsort(x)
    near = near[np.ix_(order, order)]
    while True:
        least = np.where(near, label[None, :], len(x)).min(axis=1)
        if (least == label).all():
            break
        label = least
    out = np.empty(len(x), np.uint64)
    out[order] = x[order][label]
    return out


def _bucket_links(distance: int):
    """Over (anchor, fp) rows sorted by anchor: links (fp, root) inside each anchor's bucket."""
    def links(anchor: np.ndarray, fp: np.ndarray):
        a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        edge = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        start = np.r_[0, edge]
        size = np.diff(np.r_[start, len(anchor)])
        two = start[size == 2]
        x, y = fp[two], fp[two + 1]
        near = np.bitwise_count(x ^ y) <= distance
        a.append(np.maximum(x, y)[near]), b.append(np.minimum(x, y)[near])
        for s, n in zip(start[size > 2], size[size > 2]):
            x = fp[s:s + n]
            root = _local_roots(x, distance)
            a.append(x[x != root]), b.append(root[x != root])
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def run(batches):
        anchor, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = np.r_[anchor, batch.column(0).to_numpy()]
            fp = np.r_[fp, batch.column(1).to_numpy().view(np.uint64)]
            cut = np.searchsorted(anchor, anchor[-1])  # the last bucket may go on
            if cut:
                yield links(anchor[:cut], fp[:cut])
                anchor, fp = anchor[cut:], fp[cut:]
        if len(anchor):
            yield links(anchor, fp)
    return run


def links(distinct: DataFrame, distance: int) -> DataFrame:
    """Links (a, b), a > b as unsigned, that join all fingerprints within ``distance``.

    ``distinct``: different fingerprints in column ``fp``.
    """
    def replicate(batch: pa.RecordBatch) -> dict:
        x = batch.column(0).to_numpy().view(np.uint64)
        of, at = anchors(x, distance)
        return {"anchor": at.view(np.int64), "fp": x[of].view(np.int64)}

    at = map_arrow(distinct.select("fp"), "anchor bigint, fp bigint", replicate)
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (at.repartition(n, "anchor").sortWithinPartitions("anchor")
            .mapInArrow(_bucket_links(distance), "a bigint, b bigint").distinct())


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(fp, root) for every end of an edge: smallest-label propagation with pointer jumping.

    Each round is a written table; only its count of changed labels reaches
    the driver. A label always is a member of the component, so jumping to the label's
    own label at least doubles how far labels travel.
    """
    ends = edges.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    label = scratch.save(ends.select("fp", F.col("fp").alias("root")))
    while True:
        of = lambda name: label.select(F.col("fp").alias(name), F.col("root").alias(f"root_{name}"))
        both = edges.join(of("a"), "a").join(of("b"), "b")
        sent = both.select(F.explode(F.array(
            F.struct(F.col("a").alias("fp"), F.col("root_b").alias("root")),
            F.struct(F.col("b").alias("fp"), F.col("root_a").alias("root")),
            # a root learns what its members heard
            F.struct(F.col("root_a").alias("fp"), F.col("root_b").alias("root")),
            F.struct(F.col("root_b").alias("fp"), F.col("root_a").alias("root")))).alias("m")).select("m.*")
        least = (sent.unionByName(label).groupBy("fp").agg(F.min("root").alias("root")))
        step = scratch.save(least)
        up = step.select(F.col("fp").alias("root"), F.col("root").alias("up"))
        jumped = scratch.save(step.join(up, "root").select("fp", F.col("up").alias("root")))
        changed = jumped.join(label.withColumnRenamed("root", "old"), "fp").where("root <> old").limit(1).count()
        scratch.drop(label, step)
        label = jumped
        if not changed:
            return label


def _linked(docs: DataFrame, shingle: int, distance: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Written tables: (key, k, th, fp) of every row and (fp, root, component_id) of every fingerprint."""
    scratch = Scratch(docs.sparkSession)
    own = scratch.save(fingerprints(docs.select(F.col(f"`{key}`").alias("key"), *row_key(key, text),
                                                F.col(f"`{text}`").alias("text")), shingle, out="fp"))
    distinct = scratch.save(own.groupBy("fp").agg(F.min("key").alias("least")))
    edges = scratch.save(links(distinct, distance))
    label = components(edges, scratch)
    member = distinct.join(label, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = member.groupBy("root").agg(F.min("least").alias("component_id"))
    names = scratch.save(member.join(named, "root").select("fp", "root", "component_id"))
    scratch.drop(edges, label, distinct)
    return own, names


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, fingerprint (signed 64 bits), component_id.

    Two documents are linked if their fingerprints differ in ``distance`` bits
    or less; ``component_id`` is the smallest key reachable over links, itself
    included. Null and empty texts have fingerprint zero and are linked like
    any other. Rows with equal keys stay separate rows; a null key
    gets a component but never names one (a component of null keys only has a
    null id). Other columns are not read. An empty table gives an empty result.
    """
    own, names = _linked(docs, shingle, distance, key, text)
    # both sides are scans, so AQE may split the partition of a hot fingerprint
    return own.join(names, "fp").select(F.col("key").alias(key), F.col("fp").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when each group of linked documents keeps one, with all their columns.

    The smallest key stays (a null key only if its group has no other; of rows with that key one text,
    chosen by its hash); of rows with equal key and text one stays.
    """
    own, names = _linked(docs, shingle, distance, key, text)
    first = own.join(names, "fp").groupBy("root").agg(
        F.min(F.struct(F.col("key").isNull().alias("null"), "key", "th", "k")).alias("one"))
    k, th = fresh(docs, "row_key", "row_hash")
    stays = Scratch(docs.sparkSession).save(first.select(F.col("one.k").alias(k), F.col("one.th").alias(th)).distinct())
    k_of, th_of = row_key(key, text)
    marked = docs.select("*", k_of.alias(k), th_of.alias(th))
    return marked.join(stays, [k, th], "left_semi").dropDuplicates([k, th]) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])
