"""Hard-negative mining over rotated one-bit codes with stored alignments.

Every vector is rotated (random signs and Hadamard transforms, exact in integers) and kept as
a few one-bit codes: the signs of the rotated vector, then of what the codes so far leave over. With each
code its alignment is stored (the inner product with the unit code vector), and with the vector
the norm of the last residual. An anchor's rotated vector is cut into bit planes, so that popcounts of code and
plane give its inner product with each code vector; weighted by the alignments they
estimate the score. Cauchy-Schwarz over the residual and over the planes' rounding gives an
interval that surely holds the score. Rows whose interval cannot reach the result are
left out; the rest are scored in whole numbers, so results are exact.

Rows and anchors stand in packed blocks of bounded size and meet block by block: first for the
positives, then, with the windows their scores open, for the negatives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import Scratch, map_arrow, mix64

ROWS, ANCHORS = 4096, 4096      # rows and anchors of a packed block
CODES = 4                       # one-bit codes of a vector
PLANES = 6                      # bit planes of an anchor
AT_ONCE = 1 << 18               # (anchor, row) pairs whose bounds are held at once
_NULL_ID = np.iinfo(np.int64).max


def rotate(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` times the square root of their padded length squared, rotated: signs, Hadamard, twice."""
    n, d = x.shape
    wide = max(64, 1 << max(0, d - 1).bit_length())
    y = np.zeros((n, wide))
    y[:, :d] = x
    for turn in range(2):
        sign = mix64(np.arange(wide, dtype=np.uint64) + np.uint64(wide * (turn + 1))) & np.uint64(1)
        y *= np.where(sign == 1, 1.0, -1.0)
        h = 1
        while h < wide:
            z = y.reshape(n, wide // (2 * h), 2, h)
            y = np.stack((z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]), axis=2).reshape(n, wide)
            h *= 2
    return y / wide                 # two transforms stretch by ``wide``, a power of two


def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bits: row x code x word, alignments: row x code, norms of the residuals, norms of what the codes hold)."""
    left = rotate(x)
    n, wide = left.shape
    bits = np.zeros((n, CODES, wide // 64), np.uint64)
    align = np.zeros((n, CODES))
    held = np.zeros_like(left)
    for c in range(CODES):
        plus = left >= 0
        bits[:, c] = np.packbits(plus, axis=1, bitorder="little").view("<u8")
        unit = np.where(plus, 1.0, -1.0) / np.sqrt(wide)
        align[:, c] = (left * unit).sum(axis=1)
        held += align[:, c:c + 1] * unit
        left -= align[:, c:c + 1] * unit
    return bits, align, np.linalg.norm(left, axis=1), np.linalg.norm(held, axis=1)


class Probes:
    """Anchors as bit planes: value = low + step * sum(2**b * plane_b), up to ``off``, the norm of the rounding."""

    def __init__(self, x: np.ndarray):
        y = rotate(x)
        n, self.wide = y.shape
        self.low = y.min(axis=1, initial=0)
        self.step = (y.max(axis=1, initial=0) - self.low) / ((1 << PLANES) - 1)
        self.step[self.step == 0] = 1.0
        v = np.rint((y - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        near = self.low[:, None] + self.step[:, None] * v
        self.off = np.linalg.norm(y - near, axis=1)
        self.norm = np.linalg.norm(y, axis=1)
        self.total = near.sum(axis=1)
        self.planes = np.stack([np.packbits((v >> b) & 1 == 1, axis=1, bitorder="little").view("<u8") for b in range(PLANES)], axis=1)

    def bounds(self, who: np.ndarray, bits, align, rest, held) -> tuple[np.ndarray, np.ndarray]:
        """(estimate, half width) of the scores of anchors ``who`` with coded rows."""
        est = np.zeros((len(who), len(align)))
        for c in range(bits.shape[1]):
            inside = np.zeros(est.shape)                 # sum of the anchor's values where the code has a one
            for w in range(bits.shape[2]):
                word = bits[:, c, w]
                inside += self.low[who, None] * np.bitwise_count(word)
                weighted = np.zeros(est.shape, np.int32)
                for b in range(PLANES):
                    weighted += np.bitwise_count(word & self.planes[who, b, w][:, None]).astype(np.int32) << b
                inside += self.step[who, None] * weighted
            est += align[:, c] * (2 * inside - self.total[who, None]) / np.sqrt(self.wide)
        half = rest * self.norm[who, None] + held * self.off[who, None]
        # rounding of the floating-point sums themselves, generously
        return est, half + 1e-9 * (self.norm[who, None] * (rest + held)) + 1e-6


def scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Whole-number inner products. Doubles hold them exactly below 2**53; beyond, Python's integers do."""
    if rows.shape[1] * np.abs(rows).max(initial=0) * np.abs(anchor).max(initial=0) < 2.0 ** 53:
        return (rows @ anchor).astype(np.int64)
    whole = [int(a) for a in anchor.tolist()]
    return np.array([sum(int(r) * a for r, a in zip(row, whole)) for row in rows.tolist()], np.int64)


def _best(score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k: higher scores first, ties by smaller id."""
    return np.lexsort((vec_id, -score))[:k]


class _Block:
    """A packed block, rows in the order of their labels."""

    def __init__(self, row: dict, coded: bool):
        self.rid = np.frombuffer(row["rid"], "<i8")
        self.label = np.frombuffer(row["label"], "<i8")
        self.vec_id = np.frombuffer(row["vec_id"], "<i8")
        self.x = np.frombuffer(row["x"], "<f8").reshape(len(self.rid), -1)
        if coded:
            self.align = np.frombuffer(row["align"], "<f8").reshape(len(self.rid), CODES)
            self.bits = np.frombuffer(row["bits"], "<u8").reshape(len(self.rid), CODES, -1)
            self.rest, self.held = np.frombuffer(row["rest"], "<f8"), np.frombuffer(row["held"], "<f8")


_PACKED = "dim int, block bigint, rid binary, label binary, vec_id binary, x binary"
_CODED = _PACKED + ", bits binary, align binary, rest binary, held binary"


def _pack(rows: DataFrame, size: int, coded: bool, extra: str = "") -> tuple[DataFrame, int]:
    """One row for each block (of one dimension) of about ``size`` rows; with ``extra`` that array column of each row, concatenated."""
    blocks = max(1, -(-rows.count() // size))
    keyed = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks)))

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("label", "ascending"), ("rid", "ascending")])
        dim = group["dim"][0].as_py()
        x = group["ints"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, dim)
        ids = group["vec_id"].fill_null(_NULL_ID).to_numpy()
        out = {"dim": [dim], "block": [group["block"][0].as_py()], "rid": [group["rid"].to_numpy().tobytes()],
               "label": [group["label"].to_numpy().tobytes()], "vec_id": [ids.tobytes()], "x": [x.astype("<f8").tobytes()]}
        if coded:
            out |= dict(zip(("bits", "align", "rest", "held"), ([a.tobytes()] for a in codes(x))))
        if extra:
            values = group[extra].combine_chunks()
            out |= {"size": [np.diff(values.offsets.to_numpy()).astype("<i8").tobytes()],
                    "extra": [values.flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes()]}
        return pa.table(out, schema=None).cast(pa.schema(
            [("dim", pa.int32()), ("block", pa.int64())] + [(c, pa.binary()) for c in list(out)[2:]]))

    schema = (_CODED if coded else _PACKED) + (", size binary, extra binary" if extra else "")
    return keyed.groupBy("dim", "block").applyInArrow(pack, schema), blocks


def _meet(rows: DataFrame, row_blocks: int, anchors: DataFrame, anchor_blocks: int) -> DataFrame:
    """Every block of anchors beside every block of rows of its dimension: a query set against all rows."""
    cells = min(4 * row_blocks * anchor_blocks, 20_000)
    left = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("a")) \
        .withColumnRenamed("block", "r").repartition(cells, "dim", "r", "a")
    right = anchors.select(F.col("dim"), F.col("block").cast("int").alias("a"), F.struct(
        *[F.col(c) for c in anchors.columns if c not in ("dim", "block")]).alias("anchors"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(row_blocks - 1).cast("bigint"))).alias("r")).repartition(cells, "dim", "r", "a")
    return left.hint("shuffle_hash").join(right, ["dim", "r", "a"])


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k of each group, as ``at`` from 1."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "rid")
    return rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)


def _chosen(batch: pa.RecordBatch, find) -> dict:
    out = {c: [] for c in ("arid", "window", "rid", "vec_id", "score")}
    for i in range(batch.num_rows):
        row = {c: batch.column(j)[i].as_py() for j, c in enumerate(batch.schema.names)}
        block, anchors = _Block(row, True), _Block(row["anchors"], False)
        probes = Probes(anchors.x)
        for arid, window, at, score in find(block, anchors, probes, row["anchors"]):
            out["arid"].append(np.full(len(at), arid)), out["window"].append(np.full(len(at), window))
            out["rid"].append(block.rid[at]), out["vec_id"].append(block.vec_id[at]), out["score"].append(score)
    cols = {c: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for c, v in out.items()}
    ids = cols["vec_id"].to_numpy()
    return cols | {"vec_id": pa.array(ids, pa.int64(), mask=ids == _NULL_ID)}


_FOUND = "arid bigint, window bigint, rid bigint, vec_id bigint, score bigint"


def _positives(k: int):
    def find(block: _Block, anchors: _Block, probes: Probes, _):
        for label in np.unique(anchors.label):
            s, e = (int(np.searchsorted(block.label, label, side)) for side in ("left", "right"))
            who = np.flatnonzero(anchors.label == label)
            step = max(1, AT_ONCE // max(1, e - s))
            for lo in range(0, len(who) if e > s else 0, step):
                some = who[lo:lo + step]
                est, half = probes.bounds(some, block.bits[s:e], block.align[s:e], block.rest[s:e], block.held[s:e])
                for i, a in enumerate(some):
                    est[i, block.rid[s:e] == anchors.rid[a]] = -np.inf     # a row is not its own positive
                    first = np.argpartition(-est[i], min(4 * k, e - s - 1))[:4 * k + 1]
                    first = first[est[i, first] > -np.inf]
                    if not len(first):
                        continue
                    got = np.sort(scores(block.x[s:e][first], anchors.x[a]))[::-1]
                    least = got[k - 1] if len(got) >= k else -np.inf
                    at = s + np.flatnonzero((est[i] + half[i] >= least) & (est[i] > -np.inf))
                    score = scores(block.x[at], anchors.x[a])
                    top = _best(score, block.vec_id[at], k)
                    yield anchors.rid[a], 0, at[top], score[top]
    return find


def _negatives(k: int, low: int, high: int):
    def find(block: _Block, anchors: _Block, probes: Probes, packed: dict):
        opened = np.split(np.frombuffer(packed["extra"], "<i8"), np.cumsum(np.frombuffer(packed["size"], "<i8"))[:-1])
        n = len(block.rid)
        step = max(1, AT_ONCE // max(1, n))
        for begin in range(0, len(anchors.rid), step):
            some = np.arange(begin, min(begin + step, len(anchors.rid)))
            est, half = probes.bounds(some, block.bits, block.align, block.rest, block.held)
            for i, a in enumerate(some):
                other = block.label != anchors.label[a]
                windows = {}                              # low*p <= 100*s <= high*p in whole numbers
                for p in sorted(set(opened[a].tolist())):
                    least, most = -((-low * p) // 100), (high * p) // 100
                    if least <= most:
                        windows[p] = least, most
                need = np.zeros(n, bool)
                for least, most in windows.values():
                    likely = np.flatnonzero(other & (est[i] >= least) & (est[i] <= most))
                    if len(likely) > 4 * k:
                        likely = likely[np.argpartition(-est[i, likely], 4 * k)[:4 * k]]
                    got = scores(block.x[likely], anchors.x[a])
                    got = np.sort(got[(got >= least) & (got <= most)])[::-1]
                    floor = got[k - 1] if len(got) >= k else least
                    need |= other & (est[i] + half[i] >= floor) & (est[i] - half[i] <= most)
                at = np.flatnonzero(need)
                score = scores(block.x[at], anchors.x[a])
                for p, (least, most) in windows.items():
                    inside = np.flatnonzero((score >= least) & (score <= most))
                    top = inside[_best(score[inside], block.vec_id[at[inside]], k)]
                    yield anchors.rid[a], p, at[top], score[top]
    return find


def mine(rows: DataFrame, anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, scale: int = 256, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of vectors whose components x are ``floor(scale * x)``; higher
    scores come first, ties by smaller key. ``anchor`` says which rows are anchors. A positive is one of the
    first ``positives`` other rows of the anchor's label, its negatives the first ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.

    Rows with a null label or vector, or a null or non-finite component, take no part. Vectors meet
    those of their own length only. A null key is no anchor and comes last among ties. Repeated rows are rows of their
    own: a copy of an anchor is another row, and each copy of an anchor has its own result. Labels are
    whole numbers. Other columns are not read. Scores beyond 64 bits raise an error.
    """
    scratch = Scratch(rows.sparkSession)
    x = F.col(f"`{vector}`")
    label = F.col("label") if label is None else label
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("double"))
    kept = scratch.save(rows.where(x.isNotNull()).where(~bad).select(
        F.col(f"`{key}`").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.size(x).alias("dim"), whole.alias("ints"))
        .where(F.col("label").isNotNull() & (F.col("dim") >= 0)).withColumn("rid", F.monotonically_increasing_id()))
    row_blocks, n_rows = _pack(kept.select("rid", "vec_id", "label", "dim", "ints"), ROWS, coded=True)
    row_blocks = scratch.save(row_blocks)
    chosen = kept.where(F.col("anchor") & F.col("vec_id").isNotNull()).select("rid", "vec_id", "label", "dim", "ints")
    packed, n_anchors = _pack(chosen, ANCHORS, coded=False)

    found = map_arrow(_meet(row_blocks, n_rows, packed, n_anchors), _FOUND,
                      lambda b, find=_positives(positives): _chosen(b, find), rows=1)
    best = scratch.save(_first(found, ["arid"], positives).select(
        "arid", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "at"))
    opened = best.groupBy(F.col("arid").alias("rid")).agg(F.collect_list("positive_score").alias("opened"))  # at most ``positives`` each
    packed, n_anchors = _pack(chosen.join(opened, "rid"), ANCHORS, coded=False, extra="opened")
    found = map_arrow(_meet(row_blocks, n_rows, packed, n_anchors), _FOUND,
                      lambda b, find=_negatives(negatives, low, high): _chosen(b, find), rows=1)
    hard = _first(found, ["arid", "window"], negatives)
    pairs = best.join(chosen.select(F.col("rid").alias("arid"), F.col("vec_id").alias("anchor_id")), "arid")
    return pairs.join(hard.select("arid", F.col("window").alias("positive_score"), F.col("vec_id").alias("negative_id"),
                                  F.col("score").alias("negative_score"), F.col("at").alias("rank")), ["arid", "positive_score"]) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
