"""A corpus pipeline over ``documents``: five stages, each one operator of ``tillroll.llm``.

Every stage takes (spark, docs, sf_dir) and gives the documents that go on, with the columns of
``documents``; the last gives each document's tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, decontaminate, langid, simhash, substring
from tillroll.llm.common import Scratch, read_table

ODDS = 1.3   # short texts of few letters have low odds with every language and stay


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter, or with no language ahead of the others, go."""
    return langid.recognised(docs, ODDS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that repeated windows of 35 words cover; ``n_chars`` follows the text."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"))
    out = substring.remove_repeats(rows, window=35, layout=True)
    of = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long").alias("n_chars")}
    return out.select(*[of.get(c, F.col(f"row.`{c}`")) for c in docs.columns])


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a test item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digests of the ids and of the text they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, path, decoded=True).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("BPE encoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a written table that the next one reads."""
    scratch = Scratch(spark)
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return done
        last, docs = docs, scratch.save(done)
        if i:
            scratch.drop(last)


# SQL cannot express the network, the fingerprints or the tokenizer: tests/llm/test_pipeline.py compares with brute force
ORACLE_SQL = None
