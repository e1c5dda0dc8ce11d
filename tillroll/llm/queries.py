"""Registered queries: each operator over its whole table, with the digests derived from its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tillroll.llm import (bpe, chat, decontaminate, fim, langid, linerules, negatives, pieces, qualitynet, simhash, substring,
                          tokencount, urlfilter)
from tillroll.llm.common import read_table


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
SPAM_TERMS = "casino|pills|bets|ads|spam|adult"   # as whole words of a host, which dots and hyphens part


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list's single urls are those of pages on hosts that have a spam term as a word."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    host, _ = urlfilter.host_and_path(F.col("url"))
    return urlfilter.judge(pages, URL_RULES, pages.where(host.rlike(f"(^|[.-])({SPAM_TERMS})([.-]|$)")).select("url"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(read_table(spark, sf_dir, "documents"), path, decoded=True).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualitynet.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def conversation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``conversations``, each a message of its own in the order of turns, and conversation -7, whose texts hold control strings."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema)
    return rows.unionByName(more).select("conv_id", F.col("turn").alias("seq"), F.lit("append").alias("event"),
                                         "turn", "role", "text")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = chat.read_back(chat.format_log(conversation_events(spark, sf_dir)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linerules.clean_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "n_kept_chars")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = simhash.near_duplicates(docs, shingle=3, distance=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(read_table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.restore(fim.transform(read_table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      *[F.sha2(F.col(c).cast("binary"), 256).alias(f"{d}_sha256") for c, d in (("output", "output"), ("restored", "restored"))])


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every seventh row are moved to the next one, so that negatives are hard."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved,
                          positives=5, negatives=3, low=50, high=95, scale=256)


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_urls": op1_urls,
    "op2_bpe": op2_bpe,
    "op3_quality": op3_quality,
    "op4_substring": op4_substring,
    "op5_decontamination": op5_decontamination,
    "op6_chat": op6_chat,
    "op7_language": op7_language,
    "op8_line_rules": op8_line_rules,
    "op9_simhash": op9_simhash,
    "op10_tokens": op10_tokens,
    "op11_fim": op11_fim,
    "op12_negatives": op12_negatives,
    "op13_pieces": op13_pieces,
}

from tillroll.llm.sql import SQL  # noqa: E402, F401
