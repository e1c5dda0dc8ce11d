"""URL filter, line rules, chat formatting and decontamination on small fixtures."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tillroll.llm import bloom, chat, decontaminate, linerules, urlfilter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("Example.com", "/de/", "block"), ("org", "/fr", "allow")]
URLS = [None, "", "no scheme", "http://", "http://net/", "https://EXAMPLE.net/en/x?q#f", "http://a.example.net/enx", "http://badexample.net/en/",
        "ftp://x.example.com/de/", "http://example.com/de", "http://org/french", "http://x.org/fr", "http://net?x", "http://a.net#/",
        "://b.net/x", "http://u:p@net/", "http://net:80/", "http://ÄB.net/", "http://spam.com/a/", "https://spam.com/a?utm=1", "http://spam.com/b",
        "http://..net/", "x://y://z.net/q"]


def brute_url(url, listed):
    rest = (url or "").split("://", 1)[1] if url and "://" in url else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    best = None
    for h, p, v in RULES:
        h = h.lower()
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    listed_here = bool(host) and host + path.rstrip("/") in listed
    return host, path, best and best[0], best[1] if best else "block" if listed_here else "allow"


def test_url_rules_and_list(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://net/"), (4, "http://net/")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("key", F.lit(1)).withColumn("verdict", F.lit(2))
    listed = spark.createDataFrame([("http://spam.com/a",), (None,), ("",), ("http://spam.com/a/",)], "url string")
    want = sorted(((k, *brute_url(u, {"spam.com/a"})) for k, u in rows), key=str)
    assert sorted((tuple(r) for r in urlfilter.judge(pages, RULES, listed).collect()), key=str) == want
    none = urlfilter.judge(pages, [], None).collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "allow")}
    assert urlfilter.judge(pages.limit(0), RULES, listed).count() == 0


def test_bloom_filter_has_no_false_negative_and_few_false_positives(spark):
    keys = spark.range(20000).select(F.concat(F.lit("u"), "id").alias("key"))
    blocks = bloom.blocks_for(20000)
    f = bloom.bloom(keys, blocks)
    assert bloom.possible(keys, f, blocks).count() == 20000
    others = spark.range(20000).select(F.concat(F.lit("v"), "id").alias("key"))
    assert bloom.possible(others, f, blocks).count() < 600
    few = bloom.bloom(keys, 4)   # overfull: all may pass, none is lost
    hit, rest = bloom.split(keys, few, 4, F.col("key"))
    assert hit.count() == 20000 and rest.count() == 0 and f.count() <= bloom.MAX_BLOCKS


def brute_repeat(words, n=5):
    seen = {}
    for i in range(len(words) - n + 1):
        seen.setdefault(tuple(words[i:i + n]), []).append(i)
    return len({j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + n)})


def test_line_rule_figures(docs_of):
    rng = random.Random(4)
    rows = ODD + [(100 + i, rng.choice(["", "\n"]).join(rng.choice(["a ", "b ", "c ", "# ", "x!! ", "a | ", "\n", "cookie "])
                                                         for _ in range(rng.randint(0, 60)))) for i in range(150)]
    out = linerules.clean_lines(docs_of(rows)).collect()
    assert len(out) == len(rows)
    want = []
    for k, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        rep = brute_repeat(w)
        want.append((k, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep,
                     len(w) < 10 or 100 * rep > 20 * len(w)))
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in out), key=str) == sorted(want, key=str)
    assert all(not (r.kept and r.base_failed) for r in out)


def test_lines_that_fail_go(docs_of):
    good = "\n".join(" ".join(f"word{i}x{j}" for j in range(9)) + "." for i in range(6))
    rows = [(1, good), (2, good + "\nHome | About | Shop | Contact"), (3, "\n".join(f"Home | Page{i} | Shop{i} | Sign | In" for i in range(8))),
            (4, "\n".join(f"BUY!! IT!! NOW{i}!!" for i in range(8))), (5, "\n".join(f"a{i}$$$ b### c{i}&&& d%%%" for i in range(8)))]
    out = {r.doc_id: r for r in linerules.clean_lines(docs_of(rows)).collect()}
    assert {k: r.kept for k, r in out.items()} == {1: True, 2: True, 3: False, 4: False, 5: False}
    assert out[2].cleaned == good and out[1].cleaned == good


def test_chat_round_trip_and_mask():
    rng = random.Random(2)
    parts = ["~", "<", "[", "]", "/", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/TEXT]", "~~", "a", "\n", "é", "\U0001F600", "[INST]"]
    for _ in range(500):
        m = [(rng.choice(["user", "assistant", "sys[ROLE]~"]), "".join(rng.choices(parts, k=rng.randint(0, 12))))
             for _ in range(rng.randint(0, 5))]
        text, spans = chat.render(m)
        assert chat.parse(text) == m
        assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in m if r == "assistant"]
    for broken in ("", "<s>", "<s>x</s>", "<s>[ROLE]a[TEXT]b</s>", "<s>[ROLE]a[TEXT]b<[/TEXT]</s>"):
        with pytest.raises(ValueError):
            chat.parse(broken)


def test_event_log_folds_in_order(spark):
    rows = [  # conv, seq, event, turn, role, text
        (1, 3, "delta", 1, "assistant", "lo"), (1, 2, "delta", 1, "assistant", "hel"), (1, 1, "message", 0, "user", "hi"),
        (1, 4, "edit", 0, "user", "hi there"), (1, 5, "message", 2, "user", "more"),
        (1, 6, "regenerate", 1, "assistant", None), (1, 7, "delta", 1, "assistant", "good"), (1, 8, "delta", 1, "assistant", " day"),
        (2, 1, None, None, None, None), (None, 1, "message", 0, "user", "x"), (None, 2, "message", 1, "assistant", "y"),
        (3, 1, "message", 0, "user", "same"), (3, 1, "message", 0, "user", "same"), (4, 9, "delta", 0, "assistant", "d"),
        (4, 9, "delta", 0, "assistant", "d"), (5, 2, "append", 1, "user", "z"), (5, 1, "append", 0, "user", "y"),
        (5, 2, "append", 1, "assistant", "z"), (5, 2, "append", 1, "assistant", "z")]
    log = spark.createDataFrame(rows, "conv_id bigint, seq int, event string, turn int, role string, text string").withColumn("formatted", F.lit(1))
    out = {r.conv_id: r for r in chat.read_back(chat.format_log(log.repartition(5))).collect()}
    said = {k: [(t.role, t.text) for t in r.turns] for k, r in out.items()}
    assert said == {1: [("user", "hi there"), ("assistant", "good day")], 2: [("", "")], None: [("user", "x"), ("assistant", "y")],
                    3: [("user", "same")], 4: [("assistant", "dd")],
                    5: [("user", "y"), ("assistant", "z"), ("assistant", "z"), ("user", "z")]}
    assert out[1].loss == ["good day"] and out[3].loss == []
    assert chat.format_log(log.limit(0)).count() == 0


def test_one_long_conversation(spark):
    log = spark.range(30000).select(F.lit(1).alias("conv_id"), F.col("id").alias("seq"), F.lit("message").alias("event"),
                                    F.col("id").cast("int").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                    F.concat(F.lit("t"), "id").alias("text"))
    row = chat.read_back(chat.format_log(log)).collect()[0]
    assert [t.text for t in row.turns] == [f"t{i}" for i in range(30000)]
    want = "".join(f"t{i}" for i in range(1, 30000, 2))
    assert hashlib.sha256("".join(row.loss).encode()).digest() == hashlib.sha256(want.encode()).digest()


def plain_align(p, q):
    h = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    best = 0
    for i in range(1, len(p) + 1):
        for j in range(1, len(q) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if p[i - 1] == q[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_matches_the_plain_table():
    rng = random.Random(7)
    for _ in range(200):
        p, q = ([rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(2))
        assert decontaminate.align(p, q) == plain_align(p, q)


def test_copies_edits_and_clean_documents(spark, docs_of):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(15, 60)))) for i in range(30)]
    rows, want = [], {}
    for k in range(150):
        w = rng.choices(words, k=rng.randint(0, 200))
        if k % 3 == 0:
            i, t = rng.choice(items)
            rate = rng.choice([0, 0.05, 0.1, 0.15])
            x = [rng.choice(words) if rng.random() < rate else y for y in t.split() if rng.random() > rate / 3]
            at = rng.randint(0, len(w))
            w, want[k] = w[:at] + x + w[at:], i
        rows.append((k, " ".join(w).upper() if k % 2 else ", ".join(w)))
    rows += [(900 if k is None else 900 + k, t) for k, t in ODD] + [(None, items[3][1]), (None, items[3][1])]
    bench = spark.createDataFrame(items + [(99, None), (98, "a b"), (3, items[3][1])], "item_id bigint, text string")
    found = decontaminate.contaminated(docs_of(rows), bench)
    got = {r.doc_id: r.item_id for r in found.collect()}
    assert got == {**want, None: 3} and all(r.contaminated for r in found.collect())
    kept = decontaminate.decontaminate(docs_of(rows), bench)
    assert kept.columns == docs_of(rows).columns and kept.count() == len(rows) - len(want) - 2
    assert decontaminate.contaminated(docs_of(rows).limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs_of(rows), bench.limit(0)).count() == 0


def test_blocks_of_the_test_set_agree(spark, docs_of, monkeypatch):
    items = [(i, " ".join(f"x{i}y{j}" for j in range(20))) for i in range(12)]
    rows = [(i, "pre " + t + " post") for i, t in items] + [(50, "nothing of the kind is here")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    one = sorted(map(tuple, decontaminate.contaminated(docs_of(rows), bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK", 70)
    assert sorted(map(tuple, decontaminate.contaminated(docs_of(rows), bench).collect())) == one and len(one) == 12


def brute_good(text):
    """Kept lines, rule by rule over Python strings."""
    lines = list(dict.fromkeys(x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)))
    bad, short = [], []
    for x in lines:
        words, low = re.findall(r"[^\x20\x09-\x0D]+", x), x.lower()
        dense = "".join(words)
        n = len(words)
        bad.append(10 * sum(c in "#*$%&|<>" for c in dense) > len(dense) or 2 * len(re.findall(r"!!+(?:[\x20\x09-\x0D]|$)", x)) > n
                   or (n >= 3 and 4 * len(re.findall(r"!(?:[\x20\x09-\x0D]|$)", x)) >= 3 * n) or (n > 60 and not re.search("[.!?;:,]", x))
                   or 0 < n <= 4 * len(re.findall(r"[\x20\x09-\x0D][|•·»›](?:[\x20\x09-\x0D]|$)", x))
                   or (n <= 30 and any(p in low for p in linerules.PHRASES)) or (n <= 8 and any(p in low for p in linerules.BUTTONS)))
        short.append(n <= 4 and not re.search(r"[.!?:;,…\"'”’)\]][\x20\x09-\x0D]*$", x))
    run = [any(all(0 <= j < len(short) and short[j] for j in range(i - k, i - k + 3)) for k in range(3)) for i in range(len(lines))]
    return [x for x, b, r in zip(lines, bad, run) if not b and not r]


def test_line_rules_against_python(docs_of):
    rng = random.Random(12)
    bits = ["Home", "About us", "log in", "the text goes on.", "BUY! NOW! CHEAP!", "wow!", "a • b", "x · y · z", "one | two", "it is a sentence, is it not?",
            "cookie policy of this page", "read more", "w " * 70, "w, " * 70, "### $$$", "日本語", " ", "\t", "• Contact", "end”", "Menu\r", "Sign in to go on with your account of today"]
    rows = ODD + [(100 + i, "\n".join(rng.choices(bits, k=rng.randint(0, 14)))) for i in range(300)]
    rows += [(900, "Home\nAbout\nContact\nLogin"), (901, "Home\nAbout\nThis page has a text of its own.")]
    out = linerules.clean_lines(docs_of(rows)).collect()
    want = sorted(((k, "\n".join(brute_good(t))) for k, t in rows), key=str)
    assert sorted(((r.doc_id, r.cleaned) for r in out), key=str) == want
    by = {r.doc_id: r for r in out}
    assert by[900].cleaned == "" and by[901].cleaned.startswith("Home")


def test_a_host_of_very_many_labels_is_one_row_of_little_work(spark):
    import time
    hosts = ["a." * 20_000 + "net", "a." * 20_000 + "example.com", "x" * 100_000]
    pages = spark.createDataFrame([(i, f"http://{h}/de/x") for i, h in enumerate(hosts)], "page_id bigint, url string")
    urlfilter.judge(pages.limit(0), RULES).collect()                       # the plan is compiled
    t0 = time.time()
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge(pages, RULES).collect()}
    assert got == {0: ("net/", "block"), 1: ("example.com/de/", "block"), 2: (None, "allow")}
    assert time.time() - t0 < 20


def chat_fold(events):
    """Messages as a plain list of [turn, role, text] in the order they first came."""
    msgs = []
    for _, _, event, turn, role, text in events:
        text = text or ""
        first = next((m for m in msgs if m[0] == turn), None)
        if event == "regenerate":
            msgs = [m for m in msgs if m[0] <= turn]
        if event == "append" or first is None:
            msgs.append([turn, role, "" if event == "regenerate" else text])
        elif event == "delta":
            first[2] += text
        else:
            first[2] = text if event == "edit" else ""
    return [(role, text) for _, role, text in sorted(msgs, key=lambda m: m[0])]


def test_chat_logs_of_all_events_against_a_plain_fold(spark):
    """Random logs of appends, deltas, edits and regenerations, shuffled: the fold in order of sequence."""
    rng = random.Random(6)
    rows, seq = [], {}
    for _ in range(1500):
        c = rng.choice([None, 1, 1, 1, 2, 3, 4])
        seq[c] = seq.get(c, 0) + 1
        event = rng.choice(["append", "append", "delta", "delta", "edit", "regenerate"])
        rows.append((c, seq[c], event, rng.randint(0, 6), rng.choice(["user", "assistant", "system"]), rng.choice(["a", "</s>", "[INST] x", "", None, "é\n"])))
    df = spark.createDataFrame(rows, "conv_id bigint, seq bigint, event string, turn int, role string, text string").repartition(4)
    got = {r.conv_id: [(t["role"], t["text"]) for t in r.turns] for r in chat.read_back(chat.format_log(df)).collect()}
    want = {}
    for c in seq:
        out = chat_fold(sorted((r for r in rows if r[0] == c), key=lambda r: r[1]))
        if out:
            want[c] = out
    assert got == want
