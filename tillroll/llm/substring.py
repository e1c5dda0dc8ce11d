"""Substring dedup by seed and extend over winnowed anchors.

*Seed.* The anchor of a window of ``window`` words is the smallest hash among
its ``gram``-word sequences (the rightmost of equal ones), which depends on the
window's words alone. Equal windows, wherever they stand, therefore share their
anchor at the same place, and consecutive windows mostly share it too: a *run* is
a maximal sequence of windows with one anchor. Only runs travel, about one for
every ``(window - gram) / 2`` words.

*Extend.* Documents are joined on anchors that occur twice or more. Runs of
equal words match over their whole length, which extends the seed both ways at
once; where an anchor has differing runs (the rim of a repeat), its different
runs are extended window by window, each window being compared by the hash of its
words within its anchor. The union of the matching windows of a document is the union
of its maximal repeats.

Nothing is compared pairwise: equal runs and equal windows are counted with
partial sums, and hot anchors are joined between plain scans, whose partitions AQE
splits. Keys are pairs of 64-bit hashes (of the anchor's words and of the
window's), so that texts of 1e12 words see no chance match.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import Scratch, WindowHash, map_arrow, mix64, text_bytes, text_hash

_HASH = WindowHash()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def anchor_positions(grams: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` grams, where its smallest gram stands (the rightmost)."""
    view = np.lib.stride_tricks.sliding_window_view(grams, width)
    out = np.empty(len(view), np.int64)
    for i in range(0, len(view), 1 << 16):
        out[i:i + (1 << 16)] = width - 1 - view[i:i + (1 << 16), ::-1].argmin(axis=1)
    return out + np.arange(len(view))


def runs_of(words: list[bytes], window: int, gram: int):
    """Of one document: anchor hash, run hash, first window, number of windows of each run."""
    prefix = _HASH.prefix(word_hashes(words))
    grams = mix64(_HASH.windows(prefix, gram))
    at = anchor_positions(grams, window - gram + 1)
    first = np.r_[0, np.flatnonzero(at[1:] != at[:-1]) + 1]
    count = np.diff(np.r_[first, len(at)])
    pos = at[first]
    run = _HASH.spans(prefix, first, first + count + window - 1)
    run = mix64(run ^ mix64((count.astype(np.uint64) << np.uint64(32)) | (pos - first).astype(np.uint64)))
    return grams[pos], run, first, count


def _pack(docs: DataFrame, *more: str) -> DataFrame:
    """(key, th, body) and ``more``: the text as a zstd frame, which halves what a join moves."""
    names = ["key", "th", "body", *more]

    def run(batch: pa.RecordBatch) -> dict:
        z = zstandard.ZstdCompressor(level=3)
        return {c: batch.column(i) for i, c in enumerate(names)} | {
            "body": [z.compress(b) for b in batch.column(2).to_pylist()]}
    return map_arrow(docs.select(*names), ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in names), run)


def _layout(body: bytes, keep: np.ndarray) -> bytes:
    """The kept stretches of words as they stand in ``body``, one space between them."""
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    word = np.r_[False, ~space[np.frombuffer(body, np.uint8)], False]
    start, end = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
    edge = np.diff(np.r_[False, keep, False].astype(np.int8))
    return b" ".join(body[a:b] for a, b in zip(start[np.flatnonzero(edge == 1)], end[np.flatnonzero(edge == -1) - 1]))


def repeated_spans(docs: DataFrame, scratch: Scratch, window: int = 35, gram: int = 8) -> DataFrame:
    """(key, th, spans): for each document with repeats, [first word, words] of the repeated stretches.

    ``docs``: key, th, body. Rows with equal (key, th) count as separate
    occurrences and share one row of spans.
    """
    kind = docs.schema["key"].dataType.simpleString()

    def seeds(batch: pa.RecordBatch) -> dict:
        parts = []
        for i, body in enumerate(batch.column(2).to_pylist()):
            words = body.split()
            if len(words) >= window:
                a, r, f, n = runs_of(words, window, gram)
                parts.append((a, r, np.full(len(a), i), f, n))
        a, r, i, f, n = (np.concatenate(x) for x in zip(*parts)) if parts else [np.empty(0, np.int64)] * 5
        i = pa.array(i.astype(np.int64))
        return {"anchor": a.view(np.int64), "run": r.view(np.int64), "key": batch.column(0).take(i),
                "th": batch.column(1).take(i), "first": f.astype(np.int32), "n": n.astype(np.int32)}

    runs = scratch.save(map_arrow(docs.select("key", "th", "body"),
                                  f"anchor bigint, run bigint, key {kind}, th binary, first int, n int", seeds))
    shared = scratch.save(
        runs.groupBy("anchor").agg(F.count("*").alias("c"), F.min("run").alias("r1"), F.max("run").alias("r2"))
        .where("c > 1").select("anchor", (F.col("r1") != F.col("r2")).alias("differ")))
    met = scratch.save(runs.join(shared, "anchor"))
    scratch.drop(runs, shared)

    rim = met.where("differ")
    kinds = scratch.save(rim.groupBy("anchor", "run").agg(
        F.count("*").alias("c"), F.min_by(F.struct("key", "th", "first", "n"), F.struct("key", "th", "first")).alias("one")))
    whole = rim.join(kinds.where("c > 1").select("anchor", "run"), ["anchor", "run"])

    todo = kinds.select("one.key", "one.th", F.struct("anchor", "c", "one.first", "one.n").alias("x")) \
        .groupBy("key", "th").agg(F.collect_list("x").alias("todo"))
    at = _pack(docs).alias("d").join(
        todo.alias("t"), F.expr("d.key <=> t.key AND d.th = t.th")).select("d.key", "d.th", "d.body", "t.todo")

    def extend(batch: pa.RecordBatch) -> dict:
        z, parts, seen = zstandard.ZstdDecompressor(), [], set()
        for i, (key, th, body, todo) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
            if (key, th) in seen:  # an equal row: its windows are in c already
                continue
            seen.add((key, th))
            prefix = _HASH.prefix(word_hashes(z.decompress(body).split()))
            first = np.array([x["first"] for x in todo])
            count = np.array([x["n"] for x in todo])
            start = np.repeat(first - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            parts.append((np.repeat(np.array([x["anchor"] for x in todo]), count),
                          _HASH.spans(prefix, start, start + window),
                          np.repeat(np.array([x["c"] for x in todo]), count), np.full(len(start), i), start))
        a, w, c, i, s = (np.concatenate(x) for x in zip(*parts)) if parts else [np.empty(0, np.int64)] * 5
        i = pa.array(i.astype(np.int64))
        return {"anchor": a, "w": w.view(np.int64), "c": c, "key": batch.column(0).take(i),
                "th": batch.column(1).take(i), "first": s.astype(np.int32)}

    windows = scratch.save(map_arrow(at, f"anchor bigint, w bigint, c bigint, key {kind}, th binary, first int", extend)
                           .dropDuplicates(["anchor", "w", "key", "th", "first"]))
    twice = scratch.save(windows.groupBy("anchor", "w").agg(F.sum("c").alias("sum")).where("sum > 1").select("anchor", "w"))
    single = windows.where("c = 1").join(twice, ["anchor", "w"])

    words = (F.col("n") + (window - 1)).alias("words")
    spans = (met.where("NOT differ").select("key", "th", "first", words)
             .unionByName(whole.select("key", "th", "first", words))
             .unionByName(single.select("key", "th", "first", F.lit(window).alias("words"))))
    # equal rows have the same spans: a set, map-side first, so that a group holds those of one text however often it occurs
    out = scratch.save(spans.groupBy("key", "th").agg(F.collect_set(F.struct("first", "words")).alias("span"))
                       .select("key", "th", "span.first", "span.words"))
    scratch.drop(met, kinds, windows, twice)
    return out


def remove_repeats(docs: DataFrame, window: int = 35, gram: int = 8,
                   key: str = "doc_id", text: str = "text", layout: bool = False) -> DataFrame:
    """``docs`` with every word removed that a repeated window covers.

    A window is ``window`` consecutive words of one document; it is repeated if
    the same words also start anywhere else in the input, the same document
    included. ``text`` becomes the kept words joined by one space (with ``layout`` kept stretches stay as
    they were, so that a text without repeats is unchanged); the columns
    ``n_words`` and ``n_removed`` are added (input columns of these names give way).
    Null and empty texts have no words and become empty. Repeated rows
    (equal key and text) are copies of each other, so their windows are repeats;
    rows with one key and different texts are told apart by 128 bits
    of the text; null keys are a key like any other.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must lie between 1 and window")
    scratch = Scratch(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (key, text, "n_words", "n_removed")]
    src = docs.select(F.col(f"`{key}`").alias("key"), text_hash(F.col(f"`{text}`")).alias("th"),
                      text_bytes(F.col(f"`{text}`")).alias("body"),
                      F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest") if rest else F.lit(None).cast("int").alias("rest"))
    spans = repeated_spans(src, scratch, window, gram)

    kinds = {f: src.schema[f].dataType.simpleString() for f in ("key", "rest")}
    packed = _pack(src, "rest")
    joined = packed.alias("d").join(spans.alias("s"), F.expr("d.key <=> s.key AND d.th = s.th"), "left") \
        .select("d.key", "d.th", "d.body", "d.rest", "s.first", "s.words")

    def cut(batch: pa.RecordBatch) -> dict:
        c = zstandard.ZstdDecompressor()
        kept, total, removed = [], [], []
        for body, first, words in zip(batch.column(2).to_pylist(), batch.column(4), batch.column(5)):
            body = c.decompress(body)
            own = body.split()
            n = left = len(own)
            if first.is_valid:
                f, w = first.values.to_numpy(), words.values.to_numpy()
                depth = np.zeros(n + 1, np.int64)
                np.add.at(depth, f, 1)
                np.add.at(depth, f + w, -1)
                keep = np.cumsum(depth[:-1]) == 0
                left = int(keep.sum())
                body = _layout(body, keep) if layout else body
                own = [own[i] for i in np.flatnonzero(keep).tolist()]
            kept.append(body if layout else b" ".join(own))
            total.append(n)
            removed.append(n - left)
        return {"key": batch.column(0), "text": pa.array(kept, pa.binary()).cast(pa.string()), "n_words": total,
                "n_removed": removed, "rest": batch.column(3)}

    out = map_arrow(joined, f"key {kinds['key']}, text string, n_words bigint, n_removed bigint, rest {kinds['rest']}", cut)
    order = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    of = {key: F.col("key").alias(key), text: F.col("text").alias(text)}
    return out.select(*[of.get(c, F.col(f"rest.`{c}`")) for c in order], "n_words", "n_removed")
