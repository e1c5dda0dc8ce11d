"""The corpus pipeline: every stage on its own input against brute force, and run() against the stages in a row."""

from __future__ import annotations

import random
import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as P  # noqa: E402
from tests.llm.conftest import ODD
from tests.llm.test_simhash import groups_of
from tests.llm.test_substring import brute as brute_repeats
from tillroll.llm import decontaminate as D
from tillroll.llm import langid

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with documents (clashing columns, odd and repeated rows) and a benchmark of four items."""
    root = tmp_path_factory.mktemp("corpus")
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(160).collect()
    rng = random.Random(4)
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in real if len(r.text or "") < 6000]
    texts = [r[1] for r in rows if len((r[1] or "").split()) > 60]
    item = " ".join(texts[3].split()[:40])
    edited = item.split()
    edited[7:8], edited[20:21] = ["changed"], []
    passage = " ".join(texts[5].split()[5:50])
    more = [texts[0], texts[0] + " !", f"{texts[8]} {item}", f"{texts[9]} {' '.join(edited)} end", f"{texts[10]} {passage} x", f"{texts[11]} {passage} y"]
    rows += [(10_000 + i, t, "en", "made", len(t)) for i, t in enumerate(more)]
    rows += [(k if k is None else 20_000 + k, t, rng.choice([None, "en"]), "odd", None) for k, t in ODD if len(t or "") < 2000]
    rows += rows[:6]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("row", F.lit("x")).withColumn("key", F.lit(1)).withColumn("body", F.lit("z"))
    df.repartition(5).write.parquet(str(root / "documents.parquet"))
    bench = [(1, item), (2, "a question that nobody asked in these texts at all"), (None, None), (3, "")]
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root), bench


def table(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def stages(spark, corpus, tmp_path_factory):
    """(input, output) of every stage, each output written and read again."""
    root, _ = corpus
    docs, out = spark.read.parquet(f"{root}/documents.parquet"), []
    at = tmp_path_factory.mktemp("stages")
    for i, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, root).write.parquet(str(at / str(i)))
        out.append((docs, spark.read.parquet(str(at / str(i)))))
        docs = out[-1][1]
    return out


def test_columns_stay_until_the_last_stage(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns and after.count() > 100
    assert [n for n, _ in P.STAGES] == ["language ID", "SimHash near-dedup", "substring dedup", "benchmark decontamination", "BPE encoding"]


def test_language_stage(stages):
    docs, kept = stages[0]
    model = langid.fit(docs, langid.remainder("doc_id", 4) != 2)
    n = len(model.languages)
    judged = langid.predict(docs, model, ["doc_id", "text"]).collect()
    want = Counter((r.doc_id, r.text) for r in judged if any(c.isalpha() for c in r.text or "")
                   and r.score * (n - 1) >= P.ODDS * (1 - r.score))
    assert Counter(pairs(kept)) == want
    clean = [r for r in docs.where("source <> 'odd' AND source <> 'made'").collect() if len((r.text or "").split()) > 30]
    left = {r.doc_id for r in kept.collect()}
    assert sum(r.doc_id in left for r in clean) / len(clean) > 0.98


def test_language_stage_without_labels_or_with_one_language(spark):
    rows = [(1, "words of a text", None), (2, "123 ... !", None), (3, None, None), (4, "", None), (5, "ß", None)]
    none = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert sorted(r.doc_id for r in langid.recognised(none).collect()) == [1, 5]
    one = none.withColumn("lang", F.lit("en"))
    assert sorted(r.doc_id for r in langid.recognised(one).collect()) == [1, 5]
    assert langid.recognised(none.limit(0)).count() == 0


def test_near_duplicate_stage(stages):
    docs, kept = stages[1]
    rows = pairs(docs)
    _, group = groups_of(rows)
    least = {}
    for (k, t), g in zip(rows, group):
        least.setdefault(g, set()).add(k)
    left = pairs(kept)
    of = dict(zip([(k, t) for k, t in rows], group))
    assert sorted(Counter(of[x] for x in left).values()) == [1] * len(least)          # one of each group
    assert all(k == min((x for x in least[of[k, t]] if x is not None), default=None) for k, t in left)


def test_substring_stage(stages):
    docs, kept = stages[2]
    want = Counter((k, text) for k, text, _, _ in brute_repeats(pairs(docs), 35))
    assert Counter((k, " ".join(t.split())) for k, t in ((k, t.replace("\x1c", "?")) for k, t in pairs(kept))) == Counter(
        {(k, " ".join(t.replace("\x1c", "?").split())): n for (k, t), n in want.items()})
    assert kept.where("n_chars <> length(text)").isEmpty()
    assert sum(len(t) for _, t in pairs(kept)) < sum(len(t or "") for _, t in pairs(docs))


def test_decontamination_stage(stages, corpus):
    docs, kept = stages[3]

    def copied(t):
        p = D.words_of(t or "")
        for _, text in corpus[1]:
            own = D.words_of(text or "")
            if len(own) >= 3 and p and D.align(p, own) / (D.MATCH * min(D.FULL, len(own))) >= 0.5:
                return True
        return False
    want = Counter((k, t) for k, t in pairs(docs) if not copied(t))
    assert Counter(pairs(kept)) == want and kept.count() < docs.count()


def test_token_stage(stages):
    docs, out = stages[4]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((k, tuple(library.encode(t or "", add_special_tokens=False).ids)) for k, t in pairs(docs))
    assert Counter((r.doc_id, tuple(r.ids)) for r in out.collect()) == want


def test_run_is_the_stages_in_a_row(spark, corpus, stages):
    got = Counter((r.doc_id, tuple(r.ids), r.n_tokens, r.ids_sha256) for r in P.run(spark, corpus[0]).collect())
    assert got == Counter((r.doc_id, tuple(r.ids), r.n_tokens, r.ids_sha256) for r in stages[-1][1].collect())


def test_an_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
