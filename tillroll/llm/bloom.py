"""A blocked Bloom filter as a DataFrame: one row for each block of 256 bits, built and probed by functions.

The filter travels by broadcast and never has more than ``MAX_BLOCKS`` rows: with more keys its blocks
fill up and it passes more rows, which the exact join behind it sorts out.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANES = 4                 # longs of a block, two bits set in each by a key
KEYS_PER_BLOCK = 12       # about 21 bits a key
MAX_BLOCKS = 1 << 16      # 2 MB of bits, under 8 MB as broadcast rows


def _bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    h = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("long")
    lane = []
    for i in range(LANES):
        a = F.shiftrightunsigned(h, 12 * i).bitwiseAND(F.lit(63)).cast("int")
        b = F.shiftrightunsigned(h, 12 * i + 6).bitwiseAND(F.lit(63)).cast("int")
        lane.append(F.call_function("shiftleft", one, a).bitwiseOR(F.call_function("shiftleft", one, b)))
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks)).cast("int"), lane


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """One row for each block that has a key: block and its longs b0, b1, ..."""
    block, lanes = _bits(F.col("key"), blocks)
    return (listed.select(block.alias("block"), *[m.alias(f"b{i}") for i, m in enumerate(lanes)])
            .groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"b{i}") for i in range(LANES)]))


def _probe(keyed: DataFrame, filter_: DataFrame, blocks: int, key: Column, how: str) -> tuple[DataFrame, Column]:
    block, lanes = _bits(key, blocks)
    probe = keyed.select("*", block.alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(lanes)])
    joined = probe.join(F.broadcast(filter_), "block", how)   # at most MAX_BLOCKS rows
    return joined, reduce(and_, [F.col(f"b{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}") for i in range(LANES)])


def possible(keyed: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``keyed`` (column ``key``) that the filter lets through."""
    rows, hit = _probe(keyed, filter_, blocks, F.col("key"), "inner")
    return rows.where(hit).select(*keyed.columns)


def split(rows: DataFrame, filter_: DataFrame, blocks: int, key: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that the filter lets through, the others, which surely are not among its keys)."""
    probed, hit = _probe(rows, filter_, blocks, key, "left")
    hit = F.coalesce(hit, F.lit(False))
    return probed.where(hit).select(*rows.columns), probed.where(~hit).select(*rows.columns)


def blocks_for(n: int) -> int:
    blocks = 1
    while blocks * KEYS_PER_BLOCK < n and blocks < MAX_BLOCKS:
        blocks *= 2
    return blocks
