from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those operators use."""
    from pyspark.sql import functions as F

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        clash = ("key", "k", "th", "body", "fp", "ids", "n_words", "first", "block", "anchor", "run",
                 "label", "item_id", "lang", "source", "rest", "row")
        return df.select("*", *[F.lit("x").alias(c) for c in clash])
    return make


ODD = [(None, None), (None, ""), (1, None), (1, None), (2, " \t\n "), (3, "one"), (3, "one"), (3, "two words"),
       (4, "Ä ß 日本 \U0001F600 é"), (5, "w " * 30000), (6, "x" * 100000), (7, "\x00 a <s> </s>"),
       (8, "a b　c\x0bd\x0ce\rf")]
