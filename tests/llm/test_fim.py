"""Fill-in-middle: against a plain implementation over code points, and back again."""
from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tillroll.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(key, text):
    text = text or ""
    h = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return key, n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def rows(docs):
    out = fim.restore(fim.transform(docs))
    return sorted(map(tuple, out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored").collect()), key=repr)


def test_agrees_with_a_plain_implementation(docs_of):
    rng = random.Random(5)
    bits = ["a", "Ä", "日本", "\U0001F600", " ", "\n", "\t ", "<", "P>", "<P", ">", "<S", "M>", "\x0b", "　", "\x00"]
    given = ODD + [(i, "".join(rng.choices(bits, k=rng.randint(0, 40)))) for i in range(20, 420)]
    given += [(i, f"x {s} y") for i, s in zip(range(500, 560), ["<P>", "<S>", "<M>"] * 20)]
    got = rows(docs_of(given))
    assert got == sorted((plain(*g) for g in given), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_null_output(spark, docs_of):
    assert rows(docs_of([])) == []
    odd = spark.createDataFrame([(None, "psm"), ("t", None)], "output string, form string")
    assert [r.restored for r in fim.restore(odd).collect()] == [None, "t"]
    assert fim.transform(docs_of([(None, "a b")])).select(F.col("doc_id")).first()[0] is None


def test_three_reversals_exchange_neighbours():
    buf = bytearray(b"01abcdXY9")
    fim.exchange(buf, 2, 6, 8)
    assert bytes(buf) == b"01XYabcd9"
    for form in ("psm", "spm"):
        for a in range(5):
            for b in range(a, 5):
                assert fim.unrotate(fim.rotate(b"wxyz", a, b, form), form) == b"wxyz"
