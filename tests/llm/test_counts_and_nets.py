"""Token counts against the library; the two byte networks by held-out accuracy and by gradients' effect."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tillroll.llm import langid, qualitynet, tokencount
from tillroll.llm.convnet import PAD, ByteConvNet, cut

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"
ALPHABET = ["a", "b", "e", "th", "in", "er", " ", "  ", "\n", "\t", "▁", "é", "ß", "日", "\U0001F600", "　",
            "<s>", "</s>", "<unk>", "<0x0A>", "0", "1", "%%%", '{"', "́", "\x00", "\r", "TH", "ing", "tion", "aaaa"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_counts_match_the_library(library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    texts += [s * n for s in ("a", "ab", " ", "th", "=", "-=-", "...", "aaaa b", "日") for n in range(1, 120)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3000)) for _ in range(5)]
    counter = tokencount.PieceCounter(PATH)
    assert counter.count(texts).tolist() == [len(library.encode(t)) for t in texts]
    counter.CACHE = 10
    assert counter.count(texts[:200]).tolist() == [len(library.encode(t)) for t in texts[:200]]


def test_operator_on_odd_rows(docs_of, library):
    out = tokencount.count_tokens(docs_of(ODD), PATH, limit=100).collect()
    want = sorted(((k, len((t or "").encode()), len(library.encode(t or ""))) for k, t in ODD), key=str)
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in out), key=str) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in out)
    assert tokencount.count_tokens(docs_of(ODD).limit(0), PATH).count() == 0


def test_windows_cover_every_byte():
    for n in (0, 1, 5, 8, 9, 13, 14, 100):
        text = bytes(range(1, n + 1))
        x, of = cut([text, b"", text], 8, 5)
        assert set(of.tolist()) == ({0, 2} if n else set())
        seen = set(x[of == 0].ravel().tolist()) - {PAD}
        assert seen == set(text)


def test_pair_tables_and_pieces_change_nothing():
    net = ByteConvNet({2: 3, 3: 4, 5: 2}, 3)
    rng = np.random.default_rng(0)
    texts = [rng.integers(1, 256, n, dtype=np.uint8).tobytes() for n in (0, 3, 40, 500, 5000)]
    x, _ = cut(texts, 32, 28)
    best, _ = net._responses(x)
    assert np.allclose(net.features(x), np.maximum(np.concatenate(best, axis=1), 0), atol=1e-5)
    assert np.allclose(net.mean_logits(texts, 32, 28), net.mean_logits(texts, 32, 28, group=280), atol=1e-5)
    assert (net.mean_logits(texts, 32, 28)[0] == 0).all()


def test_network_learns_a_pattern():
    rng = np.random.default_rng(1)
    x = rng.integers(97, 123, (600, 40), dtype=np.uint8)
    y = rng.integers(0, 2, 600)
    for i in np.flatnonzero(y):
        at = rng.integers(0, 36)
        x[i, at:at + 3] = (36, 36, 36)
    net = ByteConvNet({3: 4}, 2).fit(x[:400], y[:400], np.ones(400), epochs=120, batch=64)
    assert (net.logits(x[400:]).argmax(axis=1) == y[400:]).mean() > 0.95


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.identify(docs, keep=["doc_id", "lang"]).collect()
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_ignores_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(langid.remainder("doc_id", 4) == 2, "zz").otherwise(F.col("lang")))
    one = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs).collect()}
    two = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(wrong).collect()}
    assert one == two


def test_language_odd_rows(spark):
    rows = [(k, t, "en") for k, t in ODD] + [(20 + i, "the words of an english text", "en") for i in range(8)] + [
        (40 + i, "die wörter in der sprache", "de") for i in range(8)] + [(90, "123 ... !", "en"), (91, "text", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("body", F.lit(1))
    out = langid.identify(df).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[90].lang_pred == "und" and by[90].score == 0 and by[1].lang_pred == "und"
    assert by[20].lang_pred == "en" and by[40].lang_pred == "de"
    assert langid.identify(df.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = qualitynet.classify(docs, labels)
    assert out.count() == docs.count()
    got = out.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.96
    bad = [r for r in got if r.quality == 0]
    assert sum(r.predicted == 0 for r in bad) / len(bad) > 0.9
    assert all((r.score >= 0.5) == (r.predicted == 1) for r in got)


def test_quality_odd_rows(docs_of, spark):
    labels = spark.createDataFrame([(3, 1, None), (3, 1, 1), (4, 0, 1), (7, 0, 0), (None, 0, 0), (8, None, 0), (5, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    out = qualitynet.classify(docs_of(ODD), labels).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
    none = qualitynet.classify(docs_of(ODD), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    assert qualitynet.classify(docs_of(ODD).limit(0), labels).count() == 0


def test_the_sample_is_bounded_whatever_rows_are_alike(spark):
    """20,000 rows of one id, equal or not, many labels: never more than the bound."""
    from tillroll.llm.textnet import learn_sample
    one = spark.range(20_000).select(F.lit(1).alias("id"), F.lit("x").alias("label"), F.lit("same text").alias("body"))
    other = spark.range(20_000).select(F.lit(1).alias("id"), F.lit("y").alias("label"), F.concat(F.lit("t"), F.col("id")).alias("body"))
    few = spark.range(7).select(F.lit(2).alias("id"), F.lit("z").alias("label"), F.lit("b").alias("body"))
    got = {r.label: r["count"] for r in learn_sample(one.unionByName(other).unionByName(few), 10, ["id", "body"])
           .groupBy("label").count().collect()}
    assert got == {"x": 10, "y": 10, "z": 7}
    many = spark.range(3000).select("id", F.concat(F.lit("l"), F.col("id") % 1000).alias("label"), F.lit("b").alias("body"))
    assert learn_sample(many, 100, ["id", "body"]).count() <= 16 * 100
    assert learn_sample(many.limit(0), 10, ["id", "body"]).count() == 0


def test_documents_of_one_labelled_id_are_bounded(spark, monkeypatch):
    seen = []
    real = qualitynet.sample_windows
    monkeypatch.setattr(qualitynet, "sample_windows", lambda rows, *a, **k: seen.append(rows.count()) or real(rows, *a, **k))
    docs = spark.range(20_000).select(F.lit(3).cast("bigint").alias("doc_id"), F.concat(F.lit("good text "), F.col("id")).alias("text")) \
        .unionByName(spark.range(30).select((F.col("id") + 100).alias("doc_id"), F.lit("bad $$$ text").alias("text")))
    labels = spark.range(30).select((F.col("id") + 100).alias("doc_id"), F.lit(0).alias("quality")) \
        .unionByName(spark.createDataFrame([(3, 1)], "doc_id bigint, quality int"))
    assert qualitynet.fit(docs, labels, F.lit(True), per_label=50) is not None
    assert seen[0] <= 80


@pytest.mark.parametrize("which", ["language", "quality"])
def test_scores_are_a_plain_loop_over_all_windows(spark, which):
    """The registered queries' path against float64 arithmetic, window by window and filter by filter."""
    all_docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = all_docs.where("doc_id < 80").select("doc_id", "text").unionByName(
        spark.createDataFrame([(-1, ""), (-2, None), (-3, "Ab")], "doc_id bigint, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    if which == "language":
        model = langid.fit(all_docs, langid.remainder("doc_id", 4) != 2)
        net, size, step, lower = model.net, langid.SIZE, langid.STEP, True
        got = {r.doc_id: r for r in langid.predict(docs, model, ["doc_id"]).collect()}
    else:
        net = qualitynet.fit(all_docs, spark.read.parquet(f"{SF}/labels.parquet"), langid.remainder("doc_id", 3) != 1)
        size, step, lower = qualitynet.SIZE, qualitynet.STEP, False
        got = {r.doc_id: r for r in qualitynet.score(docs, net, ["doc_id"]).collect()}
    for k, t in texts.items():
        raw = (t or "").encode()
        raw = raw.lower() if lower else raw
        windows = [raw[i:i + size] for i in range(0, max(1, len(raw) - size + step), step)] if raw else []
        z = np.zeros(len(net.out_bias), np.float64)
        for w in windows:
            x = np.full(size, PAD, np.int64)
            x[:len(w)] = np.frombuffer(w, np.uint8)
            feats = []
            for width, f in net.filters.items():                   # no tables of byte pairs, no batches
                response = sum(f[j, x[j:size - width + 1 + j]].astype(np.float64) for j in range(width))
                feats.append(np.maximum(response.max(axis=0) + net.bias[width], 0))
            z += np.concatenate(feats) @ net.out.astype(np.float64) + net.out_bias
        z = z / max(1, len(windows))
        if which == "quality":
            p = 1 / (1 + np.exp(z[0] - z[1]))
            assert abs(got[k].score - p) < 1e-4, k
        else:
            e = np.exp(z - z.max())
            p = e / e.sum()
            if any(c.isalpha() for c in t or ""):
                assert got[k].lang_pred == model.languages[int(p.argmax())] and abs(got[k].score - p.max()) < 1e-4, k
            else:
                assert got[k].lang_pred == "und"
