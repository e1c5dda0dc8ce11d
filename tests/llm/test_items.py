"""Benchmark items without an id, or of one id with different texts, and the bound of the blocks."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from tillroll.llm import decontaminate


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randint(0, 9999)}" for _ in range(n))


def test_items_without_an_id_match(spark, docs_of):
    a, b = words(1, 30), words(2, 30)
    bench = spark.createDataFrame([(None, a), (None, b), (None, None), (5, b)], "item_id bigint, text string")
    rows = [(1, "pre " + a + " post"), (2, b), (3, words(3, 60)), (None, a)]
    found = {r.doc_id: r.item_id for r in decontaminate.contaminated(docs_of(rows), bench).collect()}
    assert found == {1: None, 2: 5, None: None}
    assert [r.doc_id for r in decontaminate.decontaminate(docs_of(rows), bench).collect()] == [3]


def test_texts_of_one_id_choose_their_own_seeds(spark, docs_of):
    # of each text only one stretch of gram + SPREAD - 1 words is intact; the other texts' grams must not stand between
    texts = [words(10 + i, 8) for i in range(40)]
    bench = spark.createDataFrame([(1, t) for t in texts], "item_id bigint, text string")
    rows = [(i, "x y " + " ".join(t.split()[2:6]) + f" z{i}") for i, t in enumerate(texts)]
    found = decontaminate.contaminated(docs_of(rows), bench).collect()
    assert {r.doc_id for r in found} == set(range(40)) and {r.item_id for r in found} == {1}


@pytest.mark.parametrize("ids", [lambda i: 7, lambda i: None, lambda i: i])
def test_block_is_a_bound(spark, docs_of, monkeypatch, ids):
    texts = [words(100 + i, 40) for i in range(10)] + [words(200, 300)]
    bench = spark.createDataFrame([(ids(i), t) for i, t in enumerate(texts)], "item_id bigint, text string")
    rows = [(i, "pre " + t + " post") for i, t in enumerate(texts)] + [(None, texts[0]), (99, words(5, 80))]
    one = sorted(map(tuple, decontaminate.contaminated(docs_of(rows), bench).collect()), key=str)
    sizes, lookup = [], decontaminate._lookup
    monkeypatch.setattr(decontaminate, "BLOCK", 200)
    monkeypatch.setattr(decontaminate, "_lookup", lambda spark, grams: sizes.append(grams.count()) or lookup(spark, grams))
    assert sorted(map(tuple, decontaminate.contaminated(docs_of(rows), bench).collect()), key=str) == one
    assert len(one) == 12 and len(sizes) > 2 and max(sizes) <= 200


def test_all_items_of_a_document_are_listed(spark, docs_of):
    texts = [words(300 + i, 30) for i in range(3)]
    bench = spark.createDataFrame([(1, texts[0]), (2, texts[1]), (2, texts[2]), (4, words(400, 30))], "item_id bigint, text string")
    rows = [(1, (" " + words(500, 200) + " ").join(texts)), (2, texts[0]), (2, texts[0]), (3, words(501, 80))]
    found = decontaminate.contaminated_items(docs_of(rows), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (1, 2), (1, 2), (2, 1)]


def test_one_trigram_of_a_short_item_is_no_copy(spark, docs_of):
    items = [(1, "what is the capital of France"), (2, "name the capital of Peru"), (3, "one two three")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(0, "Bern is called the capital of a federation"), (1, "Q: What is the capital of France? A"),
            (2, "so name the capital of Peru now"), (3, "count one two three four"), (4, "count one two and three")]
    found = {r.doc_id: r.item_id for r in decontaminate.contaminated(docs_of(rows), bench).collect()}
    assert found == {1: 1, 2: 2, 3: 3}


def test_items_that_open_alike_are_not_aligned_with_every_document(spark, docs_of, monkeypatch):
    """200 items x 400 documents share an opening: all pairs share seeds, hardly one is aligned."""
    opening = "which of the following statements about the given text is true"
    bench = spark.createDataFrame([(i, f"{opening} {words(1000 + i, 25)}") for i in range(200)], "item_id bigint, text string")
    rows = [(i, f"{words(5000 + i, 30)} {opening} {words(9000 + i, 30)}") for i in range(400)]
    rows += [(1000, f"pre {opening} {words(1007, 25)}")]
    made, pairs = spark.sparkContext.accumulator(0), []
    real, score = decontaminate.align, decontaminate._score
    monkeypatch.setattr(decontaminate, "align", lambda p, i: (made.add(1), real(p, i))[1])
    monkeypatch.setattr(decontaminate, "_score", lambda df, t: (pairs.append(df.count()), score(df, t))[1])
    found = decontaminate.contaminated(docs_of(rows), bench).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(1000, 7)]
    assert 0 < made.value < 200 * 401 / 100
    assert pairs[0] < 200 * 401 / 5                   # nor are the pairs made at all: they meet by rare words


def test_every_way_to_candidates_finds_the_same_links(spark, docs_of, monkeypatch):
    """Seeds of one item only, of a few, of many: the same links, whether items meet passages by seeds or by rare words."""
    rng = random.Random(3)
    opening = ["the quick brown fox jumps", "a b c d e f g"]
    items = [(i, f"{opening[i % 2]} {words(i // 3, rng.randint(2, 30))} {words(70 + i, rng.randint(0, 9))}") for i in range(60)]
    bench = spark.createDataFrame(items + [(90, "the the the the the the"), (91, "quick quick fox fox")], "item_id bigint, text string")
    rows = []
    for i in range(150):
        w = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, len(w) // 2)):
            j = rng.randrange(len(w))
            w[j:j + 1] = rng.choice([[], ["x"], [w[j], "y"]])
            if not w:
                break
        rows.append((i, f"{words(400 + i, 5)} {' '.join(w)} {words(600 + i, 5)} the the the the"))
    found = []
    for shared in (0, 3, 16, 10_000):
        monkeypatch.setattr(decontaminate, "SHARED", shared)
        found.append(sorted(map(tuple, decontaminate.links(docs_of(rows), bench).collect())))
    assert found[0] == found[1] == found[2] == found[3] and len(found[0]) > 100


def test_links_are_those_of_aligning_every_pair(spark, docs_of):
    rng = random.Random(8)
    items = [(i, words(50 + i, rng.randint(3, 40))) for i in range(25)] + [(25, ""), (26, "two words"), (27, words(51, 12))]
    rows = []
    for i in range(120):
        t = words(3000 + i, rng.randint(0, 25)).split()
        if i % 2:
            w = items[rng.randrange(25)][1].split()
            for _ in range(rng.randint(0, len(w) // 3)):                      # edits: drop, change or add a word
                j, kind = rng.randrange(len(w)), rng.random()
                w[j:j + 1] = [] if kind < 0.3 else ["changed"] if kind < 0.7 else [w[j], "added"]
                if not w:
                    break
            at = rng.randint(0, len(t))
            t[at:at] = w
        rows.append((i if i % 7 else None, " ".join(t)))
    rows += rows[:9]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    D = decontaminate
    want, intact = set(), set()
    for k, t in rows:
        p = D.words_of(t)
        for item, text in items:
            own = D.words_of(text)
            best = D.align(p, own) if p and len(own) >= 3 else 0
            if len(own) >= 3 and best >= D.MATCH * min(D.LEAST, len(own)) and best / (D.MATCH * min(D.FULL, len(own))) >= 0.5:
                want.add((k, t, item))
            span = min(3 + D.SPREAD - 1, len(own))
            if len(own) >= 3 and any(own[i:i + span] == p[j:j + span] for i in range(len(own) - span + 1) for j in range(len(p))):
                intact.add((k, t, item))
    from tillroll.llm.common import row_key
    docs = docs_of(rows)
    names = docs.select("doc_id", "text", *row_key("doc_id", "text")).dropDuplicates(["k", "th"])
    got = {(r.doc_id, r.text, r.item_id) for r in D.links(docs, bench).join(names, ["k", "th"]).collect()}
    assert got <= want and want & intact <= got and len(got) > 30


def test_the_bound_is_never_under_the_score():
    rng = random.Random(2)
    for _ in range(300):
        p, i = ([rng.choice("abcdef") for _ in range(rng.randint(1, 30))] for _ in range(2))
        assert decontaminate.align(p, i) <= decontaminate.MATCH * decontaminate.most_matches(Counter(p), Counter(i))
