"""Different texts of one key whose 32-bit hashes are equal stay different rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm.test_substring import brute, got
from tillroll.llm import bpe, decontaminate, simhash, substring
from tillroll.llm.common import row_key

A = " ".join(f"q{i}" for i in range(40)) + " 4169"
B = " ".join(f"c{i}" for i in range(40)) + " 261747"


@pytest.fixture(scope="module")
def rows(docs_of):
    return docs_of([(None, A), (7, A), (None, B)])


def test_row_key_is_wider_than_32_bits(rows):
    assert rows.select(F.hash("text")).distinct().count() == 1
    assert rows.where("doc_id IS NULL").select(*row_key("doc_id", "text")).distinct().count() == 2


def test_keep_one_keeps_both(docs_of):
    out = simhash.keep_one(docs_of([(None, A), (None, B)]))
    assert sorted(r.text for r in out.collect()) == sorted([A, B])


def test_decontaminate_keeps_the_clean_one(spark, rows):
    bench = spark.createDataFrame([(1, A)], "item_id bigint, text string")
    assert [r.text for r in decontaminate.decontaminate(rows, bench).collect()] == [B]


def test_repeats_are_cut_from_their_own_text(rows):
    assert got(substring.remove_repeats(rows)) == brute([(None, A), (7, A), (None, B)], 35)


def test_each_text_has_its_own_ids(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = sorted([library.encode(t, add_special_tokens=False).ids for t in (A, A, B)])
    assert sorted(r.ids for r in bpe.encode(rows, path).collect()) == want


def test_the_callers_settings_stay():
    """Without a shared folder a local session gets a temporary one, and its settings are not changed; a cluster is an error."""
    from types import SimpleNamespace

    from tillroll.llm import common

    def session(master, app):
        conf = SimpleNamespace(get=lambda k, d=None: d, set=lambda *a: pytest.fail("a setting was changed"))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=app))
    one = common.shared_folder(session("local", "test-app-1"))
    assert common.shared_folder(session("local[4]", "test-app-1")) == one != common.shared_folder(session("local[*]", "test-app-2"))
    with pytest.raises(ValueError):
        common.shared_folder(session("yarn", "test-app-3"))
