"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and ``_``, lower-cased. *Seeds* are word n-grams of the test
items: of every ``SPREAD`` consecutive n-grams of an item the one that the fewest training
documents hold (counted over the whole corpus), so any intact stretch of
``gram + SPREAD - 1`` words of an item holds a seed. Training passages around seed hits are joined
to the items by seed, and each (passage, item) pair with enough seeds, and with enough words in common for a
score that counts, is aligned by Smith-Waterman over words, which scores edited and paraphrased copies by what they keep. Items that open alike share
seeds; they meet passages by their rarest words instead (:func:`_candidates`), so that no seed makes all pairs.

The test set goes against all documents in blocks of at most ``BLOCK`` different n-grams, whose
hashes (8 MB) are broadcast; a larger test set makes more blocks. Blocks are cut by the n-grams themselves,
so neither a long item nor an ``item_id`` of many texts makes a block larger.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillroll.llm.common import Scratch, WindowHash, fresh, map_arrow, mix64, row_key

_WORD = re.compile(r"\w+")
_HASH = WindowHash(0xD1342543DE82EF95)
SPREAD = 2
BLOCK = 1_000_000
MARGIN = 64           # words kept on either side of seed hits, and the gap that still joins two hits
MATCH, MISMATCH, GAP = 2, -1, -1
SHARED = 16           # items that may share a seed which pairs them with its passages
LEAST = 4             # matching words that an alignment is worth at least (all, if the item has fewer), however short the item
FULL = 50             # an item's words beyond so many do not raise the score that counts as a copy


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def gram_hashes(words: list[str], n: int) -> np.ndarray:
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return mix64(_HASH.windows(_HASH.prefix(own), n))


class Lookup:
    """Membership in a bounded set of 64-bit values: a bit table first, then a binary search."""

    BITS = 24

    def __init__(self, values: np.ndarray):
        self.values = np.sort(values)
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[values >> np.uint64(64 - self.BITS)] = True

    def find(self, x: np.ndarray) -> np.ndarray:
        """Positions of ``x`` that are in the set."""
        at = np.flatnonzero(self.maybe[x >> np.uint64(64 - self.BITS)])
        if not len(at):
            return at
        i = np.minimum(np.searchsorted(self.values, x[at]), len(self.values) - 1)
        return at[self.values[i] == x[at]]


def align(passage: list[str], item: list[str]) -> int:
    """Best Smith-Waterman score of two word lists (linear gaps), one row of the table at a time."""
    number: dict[str, int] = {}
    p = np.array([number.setdefault(w, len(number)) for w in passage], np.int64)
    m = len(p)
    ramp = -GAP * np.arange(m + 1)
    row, best = np.zeros(m + 1, np.int64), 0
    for w in item:
        t = np.empty(m + 1, np.int64)
        t[0] = 0
        t[1:] = np.maximum(row[:-1] + np.where(p == number.get(w, -1), MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(t, 0, out=t)
        row = np.maximum.accumulate(t + ramp) - ramp         # gaps along the row
        best = max(best, int(row.max()))
    return best


def most_matches(passage: "Counter[str]", item: "Counter[str]") -> int:
    """Words that an alignment can match at most: those in common, each as often as both have it."""
    few, many = (item, passage) if len(item) < len(passage) else (passage, item)
    return sum(min(n, many[w]) for w, n in few.items() if w in many)


def _item_grams(items: DataFrame, n: int) -> DataFrame:
    """(ik, pos, size, gram): each item's n-grams in order, and how many it has."""
    def run(batch: pa.RecordBatch) -> dict:
        of, pos, size, gram = [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            g = gram_hashes(words_of(text), n)
            of.append(np.full(len(g), i)), pos.append(np.arange(len(g))), gram.append(g)
            size.append(np.full(len(g), len(g)))
        of = pa.array(np.concatenate(of).astype(np.int64))
        return {"ik": batch.column(0).take(of), "pos": np.concatenate(pos).astype(np.int32),
                "size": np.concatenate(size).astype(np.int32), "gram": np.concatenate(gram).view(np.int64)}
    return map_arrow(items.select("ik", "text"), "ik binary, pos int, size int, gram bigint", run)


def _blocks(grams: DataFrame) -> list[DataFrame]:
    """Different n-grams (a written table) in blocks of at most ``BLOCK``, cut by their values; at least one block."""
    n = max(1, -(-grams.count() // BLOCK))
    block = lambda: F.pmod("gram", F.lit(n))
    while n > 1 and grams.groupBy(block().alias("b")).count().agg(F.max("count")).first()[0] > BLOCK:
        n += -(-n // 8)
    return [grams.where(block() == b) for b in range(n)]


def _lookup(spark, grams: DataFrame):
    """Of one block's n-grams; at most BLOCK of them, 8 bytes each."""
    values = np.array([r[0] for r in grams.collect()], np.int64).view(np.uint64)
    return spark.sparkContext.broadcast(Lookup(values))


def _document_counts(docs: DataFrame, lookup, n: int) -> DataFrame:
    """(gram, df): in how many documents each of the block's n-grams occurs."""
    def run(batch: pa.RecordBatch) -> dict:
        found = []
        for text in batch.column(0).to_pylist():
            g = gram_hashes(words_of(text), n)
            found.append(np.unique(g[lookup.value.find(g)]))
        gram, count = np.unique(np.concatenate(found), return_counts=True)
        return {"gram": gram.view(np.int64), "df": count}
    return map_arrow(docs.select("text"), "gram bigint, df bigint", run).groupBy("gram").agg(F.sum("df").alias("df"))


_PASSAGES = "k string, th binary, at int, passage string, seeds array<bigint>"


def _cut_passages(batch: pa.RecordBatch, n: int, find: Callable[[int, np.ndarray], np.ndarray]) -> dict:
    """Of (k, th, text) rows: the stretches around the n-grams that ``find`` (row, n-grams) gives the positions of."""
    of, at, passage, seeds = [], [], [], []
    for i, text in enumerate(batch.column(2).to_pylist()):
        words = words_of(text)
        g = gram_hashes(words, n)
        hit = find(i, g)
        if not len(hit):
            continue
        for part in np.split(hit, np.flatnonzero(np.diff(hit) > MARGIN) + 1):
            lo, hi = max(0, int(part[0]) - MARGIN), int(part[-1]) + n + MARGIN
            of.append(i), at.append(int(part[0]))
            passage.append(" ".join(words[lo:hi]))
            seeds.append(np.unique(g[part]).view(np.int64))
    of = pa.array(of, pa.int64())
    return {"k": batch.column(0).take(of), "th": batch.column(1).take(of), "at": pa.array(at, pa.int32()),
            "passage": pa.array(passage, pa.string()),
            "seeds": pa.array([s.tolist() for s in seeds], pa.list_(pa.int64()))}


def _passages(docs: DataFrame, grams: DataFrame, n: int, scratch: Scratch) -> DataFrame:
    """(k, th, at, passage, seeds): stretches of documents around seed hits, with the seeds they hold.

    With one block a document is read once. With more, each block gives the places of its hits, and the passages
    are cut around the places of all blocks, so that they do not depend on how the seeds are dealt out.
    """
    spark, src = docs.sparkSession, docs.select("k", "th", "text")
    blocks = _blocks(grams)
    if len(blocks) == 1:
        only = _lookup(spark, blocks[0])
        return map_arrow(src, _PASSAGES, lambda batch: _cut_passages(batch, n, lambda i, g: only.value.find(g)))

    places = None
    for block in blocks:
        lookup = _lookup(spark, block)

        def run(batch: pa.RecordBatch, lookup=lookup) -> dict:
            hits = [lookup.value.find(gram_hashes(words_of(t), n)) for t in batch.column(2).to_pylist()]
            of = pa.array([i for i, h in enumerate(hits) if len(h)], pa.int64())
            return {"k": batch.column(0).take(of), "th": batch.column(1).take(of),
                    "places": pa.array([h.tolist() for h in hits if len(h)], pa.list_(pa.int32()))}
        own = scratch.save(map_arrow(src, "k string, th binary, places array<int>", run).dropDuplicates(["k", "th"]))
        lookup.unpersist()
        places = own if places is None else places.unionByName(own)
    places = scratch.save(places.groupBy("k", "th").agg(F.flatten(F.collect_list("places")).alias("places")))

    def cut(batch: pa.RecordBatch) -> dict:
        at = batch.column(3)
        return _cut_passages(batch, n, lambda i, g: np.sort(at[i].values.to_numpy()))
    return map_arrow(src.join(places, ["k", "th"]).select("k", "th", "text", "places"), _PASSAGES, cut)


def _score(pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs' scores. A pair whose words in common cannot reach the threshold is not aligned and scores 0."""
    def run(batch: pa.RecordBatch) -> dict:
        score, known = [], {}

        def counted(text: str, words: list[str]) -> Counter:
            if text not in known:
                if len(known) > 512:
                    known.clear()
                known[text] = Counter(words)
            return known[text]

        for passage, item in zip(batch.column(5).to_pylist(), batch.column(6).to_pylist()):
            own, around = words_of(item), passage.split(" ")
            least = MATCH * min(LEAST, len(own))
            full = MATCH * min(FULL, len(own))
            if MATCH * most_matches(counted(passage, around), counted(item, own)) < max(least, threshold * full):
                score.append(0.0)
                continue
            best = align(around, own)
            score.append(best / full if best >= least else 0.0)
        return {c: batch.column(i) for i, c in enumerate(("k", "th", "ik", "item_id", "n_seeds"))} | {"score": score}
    kind = pairs.schema["item_id"].dataType.simpleString()
    return map_arrow(pairs.select("k", "th", "ik", "item_id", "n_seeds", "passage", "item"),
                     f"k string, th binary, ik binary, item_id {kind}, n_seeds bigint, score double", run)


def _candidates(passages: DataFrame, chosen: DataFrame, items: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """(k, th, at, ik): passages and items that share a seed, without the pairs that a seed of many items cannot decide.

    A seed of up to ``SHARED`` items pairs its passages with these. Seeds of more items (texts that open alike) would pair
    everything with everything. But a copy matches at least a number of the item's words, so it holds one of the
    item's rarest words, as many as may be left unmatched and one more: passages with such a seed and items with
    such a seed meet by those words, and seeds are compared after that.
    """
    held = chosen.groupBy("gram").agg(F.count("*").alias("n"))
    common = scratch.save(held.where(F.col("n") > SHARED).select("gram"))
    seeds = passages.select("k", "th", "at", F.explode("seeds").alias("gram"))
    near = seeds.join(chosen.join(common, "gram", "left_anti"), "gram").select("k", "th", "at", "ik")
    if common.isEmpty():
        return near.distinct()
    few = chosen.join(common, "gram", "left_semi").select("ik").distinct()

    def spell(batch: pa.RecordBatch) -> dict:
        of, word, nth, size = [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            own = words_of(text)
            for w, n in Counter(own).items():
                for j in range(n):
                    of.append(i), word.append(w), nth.append(j), size.append(len(own))
        return {"ik": batch.column(0).take(pa.array(of, pa.int64())), "word": word, "nth": nth, "size": size}

    words = scratch.save(map_arrow(items.join(few, "ik").select("ik", "text"), "ik binary, word string, nth int, size int", spell))
    rarity = words.where("nth = 0").groupBy("word").agg(F.count("*").alias("in_items"))
    least = F.greatest(F.lit(1), F.least(F.lit(LEAST), "size"), F.ceil(F.lit(threshold) * F.least(F.lit(FULL), "size") - 1e-9))
    order = W.partitionBy("ik").orderBy("in_items", "word", "nth")                # one item's words
    prefix = (words.join(rarity, "word").withColumn("place", F.row_number().over(order))
              .where(F.col("place") <= F.col("size") - least + 1).select("ik", "word").distinct())
    spread = (passages.join(seeds.join(common, "gram", "left_semi").select("k", "th", "at").distinct(), ["k", "th", "at"], "left_semi")
              .select("k", "th", "at", F.explode(F.array_distinct(F.split("passage", " "))).alias("word")))
    met = spread.join(prefix, "word").select("k", "th", "at", "ik")
    return near.unionByName(met).distinct()


def links(docs: DataFrame, items: DataFrame, gram: int = 3, min_seeds: int = 1, threshold: float = 0.5,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, th, ik, item_id, n_seeds, score): every document with every item it holds a copy of, by its best passage.

    The score is the alignment's share of what ``min(item's words, 50)`` matching words would give (over 1
    for long copies of longer items); a document is listed from ``threshold`` up,
    and never for less than ``LEAST`` matching words, so that one shared n-gram of a short item is no copy.
    A pair is aligned if its passage holds ``min_seeds`` different seeds of the item, or all if
    it has fewer. ``items``: item_id, text. Items with fewer than ``gram`` words cannot be told from chance and
    never match; null texts are empty; repeated items and repeated documents give one row per different
    document and item. Items of one item_id and different texts are items of their own, so are those of a null
    item_id (which is then null in the result). Empty tables give an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    src = docs.select(*row_key(key, text), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"), *row_key("item_id", "text"))
    # an item is its id and its text: a null id, or one id of many texts, names each text on its own
    items = scratch.save(items.select("item_id", "text", F.unhex(F.md5(F.concat("th", F.encode("k", "utf-8")))).alias("ik"))
                         .dropDuplicates(["ik"]))
    grams = scratch.save(_item_grams(items, gram))
    counts = None
    for own in _blocks(scratch.save(grams.select("gram").distinct())):
        every = _lookup(spark, own)
        df = scratch.save(_document_counts(src, every, gram))
        every.unpersist()
        counts = df if counts is None else counts.unionByName(df)
    counted = grams.join(counts, "gram", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    near = W.partitionBy("ik").orderBy("pos").rowsBetween(0, SPREAD - 1)   # one item's grams
    chosen = scratch.save(
        counted.withColumn("pick", F.min(F.struct("df", "gram")).over(near))
        .where((F.col("pos") <= F.col("size") - SPREAD) | (F.col("pos") == 0))
        .select("ik", F.col("pick.gram").alias("gram")).distinct())
    rare = scratch.save(chosen.select("gram").distinct())
    passages = scratch.save(_passages(src, rare, gram, scratch).dropDuplicates(["k", "th", "at"]))
    own = items.select("ik", "item_id", F.col("text").alias("item")).join(
        chosen.groupBy("ik").agg(F.collect_list("gram").alias("own")), "ik")      # an item's seeds, bounded by its length
    near = _candidates(passages, chosen, items, threshold, scratch)
    n_seeds = F.size(F.array_intersect("seeds", "own"))
    pairs = (near.join(passages, ["k", "th", "at"]).join(own, "ik").withColumn("n_seeds", n_seeds.cast("bigint"))
             .where(F.col("n_seeds") >= F.least(F.size("own"), F.lit(min_seeds))))
    found = _score(pairs, threshold).where((F.col("score") >= threshold) & (F.col("score") > 0))
    return scratch.save(found.groupBy("k", "th", "ik").agg(
        F.first("item_id").alias("item_id"), F.max(F.struct("score", "n_seeds")).alias("b"))
        .select("k", "th", "ik", "item_id", "b.n_seeds", "b.score"))


def copies(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(k, th, item_id, n_seeds, score): the best aligned item of every document that holds a copy. See :func:`links`.

    Of equal scores the smallest item_id stays, one with an id if any.
    """
    # the negated score first, so that the least is the best score and then the smallest item
    best = links(docs, items, **options).groupBy("k", "th").agg(F.min(F.struct(
        (-F.col("score")).alias("s"), F.col("item_id").isNull().alias("null"), "item_id", (-F.col("n_seeds")).alias("n"))).alias("b"))
    return Scratch(docs.sparkSession).save(
        best.select("k", "th", "b.item_id", (-F.col("b.n")).alias("n_seeds"), (-F.col("b.s")).alias("score")))


def contaminated_items(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per contaminated document and item: key, item_id, n_seeds, score. See :func:`links`."""
    found = links(docs, items, key=key, text=text, **options)
    own = docs.select(F.col(f"`{key}`").alias("key"), *row_key(key, text)).join(found, ["k", "th"]).dropDuplicates(["k", "th", "ik"])
    return own.select(F.col("key").alias(key), "item_id", "n_seeds", "score")


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per contaminated document: key, contaminated (true), item_id, n_seeds, score. See :func:`copies`."""
    found = copies(docs, items, key=key, text=text, **options)
    own = docs.select(F.col(f"`{key}`").alias("key"), *row_key(key, text)).join(found, ["k", "th"]).dropDuplicates(["k", "th"])
    return own.select(F.col("key").alias(key), F.lit(True).alias("contaminated"), "item_id", "n_seeds", "score")


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no copy of a test item, with all their columns."""
    k, th = fresh(docs, "row_key", "row_hash")
    found = copies(docs, items, key=key, text=text, **options).select(F.col("k").alias(k), F.col("th").alias(th))
    k_of, th_of = row_key(key, text)
    marked = docs.select("*", k_of.alias(k), th_of.alias(th))
    return marked.join(found, [k, th], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])

