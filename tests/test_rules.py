"""Row-wise rules: listed rows agree with the counts, whatever keys repeat."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tillroll.operators import rules
from tillroll.operators.quality import constraint_violations
from tillroll.operators.rules import row_violations, rule_name

RULES = [
    ("people", "pk", ("id",), None), ("people", "unique", ("mail", "zone"), None), ("people", "not_null", ("name", "gone"), None),
    ("people", "check_in", ("kind",), ("a", "b")), ("people", "fk", ("boss",), ("people", "id")), ("people", "fk", ("town",), ("towns", "town")),
]


def make(spark, seed, n=300):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice(x)
    rows = [(pick(None, 7, 7, 7, *range(60)), pick(None, "m", "m2", f"u{rng.randint(0, 90)}"), pick(None, 1, 2), pick("x", "y", None),
             pick("a", "b", "c", None), pick(None, 7, rng.randint(0, 90)), pick(None, "t1", "t2", "nowhere")) for _ in range(n)]
    rows += rows[:40] + rows[:5]
    people = spark.createDataFrame(rows, "id bigint, mail string, zone int, name string, kind string, boss bigint, town string").repartition(4)
    return {"people": people, "towns": spark.createDataFrame([("t1",), ("t2",), (None,)], "town string")}, rows


def brute(rows):
    """(row, broken rules) -> number of rows; of equal keys the first in the order of columns keeps it."""
    order = lambda r: tuple((x is not None, x) if x is not None else (False, 0) for x in r)
    ids, towns = {r[0] for r in rows}, {"t1", "t2"}
    found = Counter()
    seen_id, seen_mail = set(), set()
    used = lambda r: (r[0], r[1], r[2], r[3], r[4], r[5], r[6])
    for r in sorted(rows, key=lambda r: order(used(r))):
        bad = []
        if r[0] is None:
            bad.append("pk_not_null(id)")
        if r[0] in seen_id:
            bad.append("pk(id)")
        seen_id.add(r[0])
        if r[1] is not None and r[2] is not None:
            if (r[1], r[2]) in seen_mail:
                bad.append("unique(mail,zone)")
            seen_mail.add((r[1], r[2]))
        if r[3] is None:
            bad.append("not_null(name)")
        if r[4] == "c":
            bad.append("check_in(kind)")
        if r[5] is not None and r[5] not in ids:
            bad.append("fk(boss)")
        if r[6] is not None and r[6] not in towns:
            bad.append("fk(town)")
        if bad:
            found[used(r), tuple(sorted(bad))] += 1
    return found


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_listed_rows_and_their_counts(spark, seed):
    tables, rows = make(spark, seed)
    got, per_rule = Counter(), Counter()
    for r in row_violations(tables, "people", RULES).collect():
        got[tuple(r)[1:8], tuple(r.failed)] += r.rows
        for name in r.failed:
            per_rule[name] += r.rows
    assert got == brute(rows)
    counts = constraint_violations(tables, RULES).where("checked").collect()
    assert {rule_name(c.rule, c.columns.split(",")): c.violations for c in counts if c.violations} == per_rule


def test_no_rows_no_violations(spark):
    tables, _ = make(spark, 1)
    assert row_violations({"people": tables["people"].limit(0), "towns": tables["towns"]}, "people", RULES).count() == 0
    assert row_violations(tables, "towns", RULES).count() == 0


@pytest.mark.parametrize("join", ["10MB", "-1"])
def test_large_tables_are_dealt_by_their_rows(spark, monkeypatch, join):
    """A part of 10 rows: every join and count of the 345 rows lies in 35 partitions, not in the session's 8."""
    monkeypatch.setattr(rules, "ROWS_A_PART", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", join)
    try:
        tables, rows = make(spark, 4)
        counts = {}
        out = row_violations(tables, "people", RULES, counts)
        dealt = re.findall(r"hashpartitioning\(.*, (\d+)\)", out._jdf.queryExecution().executedPlan().toString())
        got = Counter()
        for r in out.collect():
            got[tuple(r)[1:8], tuple(r.failed)] += r.rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert counts["people"] == len(rows) == 345 and got == brute(rows)
    assert "35" in dealt and (join != "-1" or {*dealt} == {"35"}), dealt


def test_frequent_keys_are_summed_in_several_tasks(spark):
    df = spark.range(0, 10_000, 1, 16).selectExpr("if(id % 3 = 0, null, id % 500) AS k", "id % 7 AS v")
    want = {r.k: r.s for r in df.groupBy("k").agg({"v": "sum"}).withColumnRenamed("sum(v)", "s").collect()}
    out = rules.totals(df, ["k"], rules.F.col("v"), "s", 20)
    assert {r.k: r.s for r in out.collect()} == want
    assert "hashpartitioning(k#" in (plan := out._jdf.queryExecution().executedPlan().toString()) and "_some" in plan


def test_rows_of_a_frequent_key_lie_in_several_tasks(spark):
    df = spark.range(0, 4_000, 1, 16).selectExpr("if(id % 3 = 0, null, id) AS k", "id")
    found = rules.totals(df, ["k"], rules.F.lit(1), "n", 8)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(rules, "ROWS_A_PART", 100)
        out = rules.looked_up(df, found, ["k"], "n", 40).cache()
    rows = out.collect()
    assert len(rows) == 4_000 and all(r.n == (1334 if r.k is None else 1) for r in rows)
    tasks = Counter(r.t for r in out.where("k IS NULL").select(rules.F.spark_partition_id().alias("t")).collect())
    assert max(tasks.values()) < 700, tasks
