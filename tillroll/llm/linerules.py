"""Quality rules, line first, in DataFrame functions only.

Every line with a word is judged by itself; failing lines are removed, and a
document that loses too much of its text is rejected:

* punctuation: its share of symbol characters is too high, most of its words end in "!!" or more, three quarters
  of three or more words end in "!", or it goes on for more than ``LONG`` words without any stop
* navigation: it has a lone separator (``| • · » ›``) for every four words or more, or it is one of
  ``RUN`` or more short lines in a row that end without a stop, as menus of one link a line do
* boilerplate: it equals an earlier line of the document, or holds a phrase of a notice (up to 30
  words) or of a button (up to 8)

Document-wide base rules (too few words, too many words in repeated windows) come beside them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 5
PHRASES = ("cookie", "javascript", "all rights reserved", "terms of use", "privacy policy", "subscribe to")
BUTTONS = ("click here", "read more", "sign in", "sign up", "log in", "share this", "add to cart", "skip to content")
SEPARATOR = r"[\x20\x09-\x0D][|•·»›]([\x20\x09-\x0D]|$)"
STOP = r"""[.!?:;,…"'”’)\]][\x20\x09-\x0D]*$"""      # at a line's end
SHORT, RUN = 4, 3          # words of a short line, and how many in a row are a menu
LONG = 60                  # words of a line that has no stop at all


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where ``body`` uses it in lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)


def repeated_window_words(words: Column, n: int = WINDOW) -> Column:
    """How many words stand in windows of ``n`` words that occur twice or more (the first included).

    Windows go by a 64-bit hash; if no two hashes are equal, none repeats. Else hashes are sorted with
    their starts, and neighbours of equal hash compare their words. A word counts once: the sorted
    starts ``p`` of repeated windows cover ``min(n, next - p)`` words each.
    """
    def count(w):
        def repeated(h):
            def starts(s):
                def same(x, y):
                    return F.coalesce((x["h"] == y["h"]) & (F.slice(w, x["i"], n) == F.slice(w, y["i"], n)), F.lit(False))
                return F.sort_array(F.transform(
                    F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1))), lambda x: x["i"]))

            def covered(p):
                return F.aggregate(
                    F.transform(p, lambda x, k: F.least(F.lit(n), F.coalesce(F.get(p, k + 1) - x, F.lit(n)))),
                    F.lit(0).cast("int"), lambda a, b: a + b)
            pairs = F.sort_array(F.transform(h, lambda x, k: F.struct(x.alias("h"), (k + 1).alias("i"))))
            return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                let(pairs, lambda s: let(starts(s), covered)))
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)),
                             lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(n)]))
        return F.when(F.size(w) <= n, F.lit(0)).otherwise(let(hashes, repeated))
    return let(words, count)


def judge_line(line: Column) -> Column:
    """line, bad (it breaks a rule by itself) and short (few words and no stop at the end)."""
    def judge(c):
        chars, words = c["chars"], c["words"]
        symbols = chars - F.length(F.regexp_replace(c["dense"], SYMBOL, ""))
        # counted only where the sign occurs at all
        shouted = F.when(line.contains("!!"), F.regexp_count(line, F.lit(r"!!+([\x20\x09-\x0D]|$)"))).otherwise(0)
        called = F.when(line.contains("!"), F.regexp_count(line, F.lit(r"!([\x20\x09-\x0D]|$)"))).otherwise(0)
        cells = F.regexp_count(line, F.lit(SEPARATOR))
        holds = lambda phrases: reduce(or_, [F.lower(line).contains(x) for x in phrases])
        punctuation = ((symbols * 10 > chars) | (shouted * 2 > words) | ((words >= 3) & (called * 4 >= words * 3))
                       | ((words > LONG) & ~line.rlike("[.!?;:,]")))
        navigation = (cells >= 1) & (cells * 4 >= words)
        boilerplate = ((words <= 30) & holds(PHRASES)) | ((words <= 8) & holds(BUTTONS))
        return F.struct(line.alias("line"), (punctuation | navigation | boilerplate).alias("bad"),
                        ((words <= SHORT) & ~line.rlike(STOP)).alias("short"))

    dense = F.regexp_replace(line, SPACE, "")
    return let(dense, lambda d: let(F.struct(d.alias("dense"), F.length(d).alias("chars"), F.regexp_count(line, F.lit(WORD)).alias("words")), judge))


def good_lines(lines: Column) -> Column:
    """Those of the distinct lines that pass: neither bad by themselves nor in a run of short ones."""
    def kept(judged):
        def short(k):
            return F.coalesce(F.get(judged, k)["short"], F.lit(False))

        def in_run(x, k):      # RUN = 3: the lines before and behind, the two before, or the two behind
            return x["short"] & ((short(k - 1) & (short(k - 2) | short(k + 1))) | (short(k + 1) & short(k + 2)))
        return F.transform(F.filter(judged, lambda x, k: ~x["bad"] & ~in_run(x, k)), lambda x: x["line"])
    return let(F.transform(lines, judge_line), kept)


def clean_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", lost_percent: int = 50,
                least_words: int = 10, repeat_percent: int = 20) -> DataFrame:
    """Per row: key, the base figures, cleaned text, n_kept_chars, base_failed and kept.

    Words are runs of characters other than space and U+0009..U+000D; lines end at ``\\n`` only. A null text is
    an empty one: no words, so it fails. A document is kept if it passes the base rules and the
    removed lines hold at most ``lost_percent`` of the characters of its words. Each row is judged
    alone, so repeated rows, null keys and hot sources need no rule; other columns are not read.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(F.col(f"`{key}`").alias("key"), body.alias("body"))
    lines = F.filter(F.split("body", "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    # distinct lines in order of first appearance; equal lines fail or pass alike
    figures = let(lines, lambda own: let(F.array_distinct(own), lambda first: F.struct(
        (F.size(own) - F.size(first)).cast("long").alias("n_dup_lines"),
        good_lines(first).alias("good"))))
    dense = F.regexp_replace("body", SPACE, "")
    step = base.select(
        "key", let(dense, lambda d: F.struct(
            F.length(d).cast("long").alias("word_chars"),
            (F.length(d) - F.length(F.regexp_replace(d, SYMBOL, ""))).cast("long").alias("n_symbols"))).alias("c"),
        let(words_of(F.col("body")), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_window_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        figures.alias("l"))
    cleaned = F.array_join("l.good", "\n")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return (step.select("key", "w.n_words", "c.word_chars", "c.n_symbols", "l.n_dup_lines", "w.n_repeat_words",
                        cleaned.alias("cleaned"),
                        F.length(F.regexp_replace(cleaned, SPACE, "")).cast("long").alias("n_kept_chars"))
            .select("*", failed.alias("base_failed"))
            .select(F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "cleaned", "n_kept_chars", "base_failed",
                    (~failed & ((100 - lost_percent) * F.col("word_chars") <= 100 * F.col("n_kept_chars"))).alias("kept")))
