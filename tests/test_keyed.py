"""Checked appends: verdicts against a plain pass over rows, idempotence, and what is read of the history."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.keyed import KeyedTable, key_ranges, within

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("id", T.LongType()), ("mail", T.StringType()), ("kind", T.StringType()), ("boss", T.LongType()), ("town", T.StringType()),
    ("name", T.StringType()))])
RULES = [("people", "pk", ("id",), None), ("people", "unique", ("mail",), None), ("people", "not_null", ("name",), None),
         ("people", "check_in", ("kind",), ("a", "b")), ("people", "fk", ("town",), ("towns", "town")),
         ("people", "fk", ("boss",), ("people", "id"))]
TOWNS = ["t1", "t2"]


def some(seed, n=120):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice(x)
    rows = [(pick(None, 5, rng.randint(0, 150), rng.randint(0, 150)), pick(None, f"u{rng.randint(0, 200)}", f"u{rng.randint(0, 200)}"), pick("a", "b", "a", None, "c"),
             pick(None, None, None, rng.randint(0, 150)), pick(None, "t1", "t2", "t1", "far"), pick("x", "y", "z", "x", None)) for _ in range(n)]
    return rows + rows[:15] + rows[:4]


def order(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


def judge(stored, batch):
    """Counter of (row, verdict, rules); the stored rows after the append."""
    found, rows = Counter(), Counter(batch)
    failed = {}
    for r in rows:
        bad = ["pk_not_null(id)"] * (r[0] is None) + ["not_null(name)"] * (r[5] is None) + ["check_in(kind)"] * (r[2] == "c")
        failed[r] = bad + ["fk(town)"] * (r[4] not in (None, *TOWNS))
    while True:                                             # bosses are stored, or faultless rows of the batch
        known = {s[0] for s in stored} | {r[0] for r in rows if not failed[r]}
        lost = [r for r in rows if not failed[r] and r[3] is not None and r[3] not in known]
        if not lost:
            break
        for r in lost:
            failed[r].append("fk(boss)")
    here = set(stored)
    for r in rows:
        if r not in here:
            failed[r] += ["pk(id)"] * any(s[0] == r[0] for s in stored)
            failed[r] += ["unique(mail)"] * (r[1] is not None and any(s[1] == r[1] for s in stored))
    for i, name in ((0, "pk(id)"), (1, "unique(mail)")):
        taken = set()
        for r in sorted((r for r in rows if not failed[r] and r not in here and (i == 0 or r[i] is not None)), key=order):
            if r[i] in taken:
                failed[r].append(name)
            taken.add(r[i])
    kept = []
    for r, n in rows.items():
        if r in here:
            found[r, "present", ()] += n
        elif failed[r]:
            found[r, "rejected", tuple(sorted(failed[r]))] += n
        else:
            found[r, "accepted", ()] += 1
            kept.append(r)
            if n > 1:
                found[r, "rejected", ("pk(id)",)] += n - 1
    return found, list(stored) + kept


def verdicts(df):
    out = Counter()
    for r in df.collect():
        out[tuple(r[c] for c in SCHEMA.names), r.verdict, tuple(r.failed)] += r.rows
    return out


@pytest.fixture
def towns(spark):
    return {"towns": spark.createDataFrame([(t,) for t in TOWNS] + [(None,)], "town string")}


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_batches_one_after_another(spark, towns, tmp_path):
    table, stored = KeyedTable(spark, str(tmp_path / "people"), "people", SCHEMA, RULES), []
    assert table.read().count() == 0
    for i, rows in enumerate([some(1), some(2), [], some(3)]):
        want, after = judge(stored, rows)
        got = table.append(frame(spark, rows), towns, f"day-{i}")
        assert verdicts(got) == want
        assert Counter(map(tuple, table.read().collect())) == Counter(after)
        stored = after
    # once more, under another name: what was taken is present, and nothing changes
    want, after = judge(stored, some(2))
    assert verdicts(table.append(frame(spark, some(2)), towns, "again")) == want and after == stored
    assert not any(v == "accepted" for _, v, _ in want)
    assert Counter(map(tuple, table.read().collect())) == Counter(stored)
    assert table.batches() == ["day-0", "day-1", "day-3"]
    with pytest.raises(FileExistsError):
        table.append(frame(spark, some(9)), towns, "day-0")
    assert Counter(map(tuple, table.read().collect())) == Counter(stored)


def test_a_failed_append_stores_nothing(spark, towns, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "people"), "people", SCHEMA, RULES)
    good = [(i, None, "a", None, None, "n") for i in range(50)]
    table.append(frame(spark, good), towns, "one")
    late = frame(spark, [(i, None, "a", None, None, "n") for i in range(100, 200)])
    broken = late.withColumn("name", F.when(F.col("id") == 150, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        table.append(broken, towns, "two")
    assert table.batches() == ["one"] and table.read().count() == 50
    table.append(late, towns, "two")
    assert table.read().count() == 150


def test_history_is_read_where_keys_may_meet(spark, towns, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "people"), "people", SCHEMA, RULES)
    for day in range(3):
        table.append(spark.range(day * 1000, day * 1000 + 1000).select(
            "id", F.lit(None).cast("string").alias("mail"), F.lit("a").alias("kind"), F.lit(None).cast("bigint").alias("boss"),
            F.lit("t1").alias("town"), F.lit("n").alias("name")), towns, f"d{day}")
    batch = frame(spark, [(1500, None, "a", None, "t1", "n"), (1501, None, "b", None, "t1", "n"), (5000, None, "a", 2, "t1", "n")])
    near = table._near(batch, table.read(), ("id",))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "GreaterThanOrEqual(id,1500)" in plan and "LessThanOrEqual(id,1501)" in plan
    assert sorted(r.id for r in near.collect()) == [1500, 1501]
    got = {r.id: (r.verdict, tuple(r.failed)) for r in table.check(batch, towns).collect()}
    assert got == {1500: ("present", ()), 1501: ("rejected", ("pk(id)",)), 5000: ("accepted", ())}


def test_ranges_hold_every_key(spark):
    rng = random.Random(4)
    keys = [rng.choice([0, 10**6, -10**12, 2**62]) + rng.randint(0, 5000) for _ in range(3000)]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "id bigint")
    ranges = key_ranges(df, "id")
    assert len(ranges) <= 64 and df.where(within("id", ranges)).count() == 3000
    assert sum(hi - lo for lo, hi in ranges) < 10**17                     # the wide gaps are left out
    assert key_ranges(df.limit(0), "id") == [] and key_ranges(df.where("id IS NULL"), "id") == []
    words = spark.createDataFrame([("b",), ("a",), (None,)], "id string")
    assert key_ranges(words, "id") == [("a", "b")]


def test_batch_ids_are_names(spark, tmp_path):
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path / "t"), "people", SCHEMA, RULES).append(frame(spark, []), None, "../x")
