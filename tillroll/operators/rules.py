"""Declared rules row by row: which rows break which rules.

``quality.constraint_violations`` counts; here every offending row is listed with an array of the rules it
breaks, so that it can be quarantined or refused (``sources.keyed`` checks batches by it). The counts agree:
rows listed with a rule are as many as that rule's violations.

A rule is named ``kind(columns)``: pk_not_null, not_null, check_in, pk, unique, fk. Of rows that share a key
the first, in the order of their columns, keeps it and the others break the rule; equal rows are listed
once with their number. Keys are counted in partial aggregates and only rows whose key occurs
twice meet by key, so a key that holds a third of all rows lies in no single task.

Tables of many rows are dealt over partitions by their number of rows (``parts``), not by the session's
setting alone, so that what a task sorts and counts stays the same however large they are.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources import schema as S

ROWS_A_PART = 500_000
SOME = 32   # tasks that share a frequent key


def parts(spark: SparkSession, rows: int) -> int | None:
    """Partitions for ``rows`` rows, None to leave a small table to the session's setting and Spark's merging."""
    if rows <= 2 * ROWS_A_PART:
        return None
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_PART))


def dealt(df: DataFrame, n: int | None, *cols: str) -> DataFrame:
    """``df`` in ``n`` partitions by ``cols``; what is joined to it by them is then dealt alike."""
    return df.repartition(n, *cols) if n else df


def totals(df: DataFrame, cols, each: Column, to: str, n: int | None, agg=F.sum) -> DataFrame:
    """The sum (or ``agg``) of ``each`` by ``cols``; over ``n`` partitions a frequent key is first summed in several tasks."""
    if not n:
        return df.groupBy(*cols).agg(agg(each).alias(to))
    some = df.select(*cols, each.alias("_each"), (F.spark_partition_id() % SOME).alias("_some"))
    some = dealt(some, n, *cols, "_some").groupBy(*cols, "_some").agg(agg("_each").alias("_each"))
    return dealt(some, n, *cols).groupBy(*cols).agg(agg("_each").alias(to))


def looked_up(df: DataFrame, found: DataFrame, cols, rows: str, n: int | None) -> DataFrame:
    """``df`` with the other columns of ``found``, which has a row a key and the key's ``rows`` in ``df``; NULLs are equal.

    Over ``n`` partitions the rows of a key of more than a part's rows, of which there are fewer than ``n``, are
    dealt over several tasks and what is found for it is given to each.
    """
    def renamed(to: DataFrame, *more) -> tuple[DataFrame, Column]:
        return (to.select(*[F.col(c).alias(f"_k{c}") for c in cols], *more),
                reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k{c}")) for c in cols]))

    values = [c for c in found.columns if c not in cols]
    drop = [f"_k{c}" for c in cols]
    if not n:
        keyed, on = renamed(found, *values)
        return df.join(keyed, on, "left").drop(*drop)
    large = F.col(rows) > ROWS_A_PART
    many, on = renamed(found.where(large), F.lit(True).alias("_many"))
    task = F.when(F.col("_many"), F.spark_partition_id() % SOME).otherwise(F.lit(0)).alias("_some")
    # equal structs have equal fields or NULL in both; both sides of one type, or Spark would cast and deal anew
    kinds = "struct<" + "".join(f"c{i}:{df.schema[c].dataType.simpleString()}," for i, c in enumerate(cols)) + "_some:int>"
    df = df.join(F.broadcast(many), on, "left").withColumn("_at", F.struct(*cols, task).cast(kinds)).drop(*drop, "_many")
    tasks = F.explode(F.when(large, F.sequence(F.lit(0), F.lit(SOME - 1))).otherwise(F.array(F.lit(0)))).alias("_some")
    each = found.select("*", tasks).select(F.struct(*cols, "_some").cast(kinds).alias("_to"), *values)
    return df.join(dealt(each, n, "_to"), F.col("_at") == F.col("_to"), "left").drop("_at", "_to")


def rule_name(kind: str, cols) -> str:
    return f"{kind}({','.join(cols)})"


def row_rules(columns, rules: list[tuple]) -> list[tuple[str, Column]]:
    """(name, condition that a row breaks it) of the rules that a row shows by itself; rules are (kind, columns, argument)."""
    found = []
    for kind, cols, arg in rules:
        if any(c not in columns for c in cols) and kind != "not_null":
            continue
        if kind == "pk":
            found.append((rule_name("pk_not_null", cols), reduce(or_, [F.col(c).isNull() for c in cols])))
        elif kind == "not_null":
            found += [(rule_name(kind, [c]), F.col(c).isNull()) for c in cols if c in columns]
        elif kind == "check_in":
            c = F.col(cols[0])
            found.append((rule_name(kind, cols), c.isNotNull() & ~F.coalesce(c.isin(list(arg)), F.lit(False))))
    return found


def broken(found: list[tuple[str, Column]]) -> Column:
    """The names of the conditions that hold, as an array."""
    if not found:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in found]))


def with_orphans(df: DataFrame, tables: dict[str, DataFrame], rules: list[tuple], to: str,
                 counts: dict[str, int] | None = None) -> DataFrame:
    """``df`` with the broken fk rules added to its array column ``to``; NULL keys refer to nothing.

    ``counts`` has the rows of ``df`` (key '') and of tables counted before; others are counted and added.
    """
    counts = {} if counts is None else counts
    for kind, cols, arg in rules:
        if kind != "fk" or cols[0] not in df.columns or arg[0] not in tables:
            continue
        for name, rows in (("", df), (arg[0], tables[arg[0]])):
            if name not in counts:
                counts[name] = rows.count()
        n = parts(df.sparkSession, max(counts[""], counts[arg[0]]))
        parent = tables[arg[0]].select(F.col(arg[1]).alias("_parent")).where("_parent IS NOT NULL")
        parent = dealt(parent, n, "_parent").distinct()
        key = F.col(cols[0])
        df = df.join(parent, key == F.col("_parent"), "left").withColumn(
            to, F.when(key.isNotNull() & F.col("_parent").isNull(),
                       F.array_append(to, F.lit(rule_name(kind, cols)))).otherwise(F.col(to))).drop("_parent")
    return df


def same(a: str, b: str, cols) -> Column:
    """Rows ``a`` and ``b`` agree in ``cols``, NULLs included."""
    return reduce(and_, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])


def _whole_key(kind: str, cols) -> Column:
    """Whether a key takes part: a unique key with a NULL collides with none; a primary key's NULLs count as equal."""
    return reduce(and_, [F.col(c).isNotNull() for c in cols]) if kind == "unique" else F.lit(True)


def row_violations(tables: dict[str, DataFrame], table: str, rules=None, counts: dict[str, int] | None = None) -> DataFrame:
    """Rows of ``table`` that break a rule: table, its rules' columns, failed (array of rule names), rows (how many equal ones).

    ``counts`` keeps the tables' numbers of rows from one call to the next.
    """
    counts = {} if counts is None else counts
    rules = [r[1:] for r in (rules or S.RULES) if r[0] == table]
    df = tables[table]
    if table not in counts:
        counts[table] = df.count()
    n = parts(df.sparkSession, counts[table])
    used = list(dict.fromkeys(c for _, cols, _ in rules for c in cols if c in df.columns))
    base = df.select(*used)
    counts[""] = counts[table]
    base = with_orphans(base.withColumn("failed", broken(row_rules(df.columns, rules))), tables, rules, "failed", counts)
    keys = [(kind, cols) for kind, cols, _ in rules if kind in ("pk", "unique") and all(c in df.columns for c in cols)]
    # keys that occur more than once; every other row is judged already
    marked = base
    for i, (kind, cols) in enumerate(keys):
        twice = totals(df.where(_whole_key(kind, cols)), cols, F.lit(1), f"_twice{i}", n).where(f"_twice{i} > 1")
        marked = looked_up(marked, twice, cols, f"_twice{i}", n)
    shared = reduce(or_, [F.col(f"_twice{i}").isNotNull() for i in range(len(keys))]) if keys else F.lit(False)
    flags = [f"_twice{i}" for i in range(len(keys))]
    out = marked.where(~shared & (F.size("failed") > 0)).select(*used, "failed", F.lit(1).cast("bigint").alias("rows"))
    if keys:
        meet = totals(marked.where(shared), [*used, "failed", *flags], F.lit(1).cast("bigint"), "rows", n)
        rest = [c for c in used]
        for i, (kind, cols) in enumerate(keys):
            first = totals(meet.where(F.col(f"_twice{i}").isNotNull()), [*cols, f"_twice{i}"], F.struct(*rest), f"_first{i}", n, F.min)
            meet = looked_up(meet, first.withColumnRenamed(f"_twice{i}", "_rows"), cols, "_rows", n).drop("_rows")
        # copy one of equal rows keeps the key if it is the first; further copies never do
        def failed(copy: int) -> Column:
            got = F.col("failed")
            for i, (kind, cols) in enumerate(keys):
                name = F.lit(rule_name(kind, cols))
                lost = F.col(f"_twice{i}").isNotNull()
                if copy == 1:
                    lost = lost & ~F.struct(*rest).eqNullSafe(F.col(f"_first{i}"))
                got = F.when(lost, F.array_append(got, name)).otherwise(got)
            return got

        copies = F.explode(F.array(F.struct(failed(1).alias("failed"), F.lit(1).cast("bigint").alias("rows")),
                                   F.struct(failed(2).alias("failed"), (F.col("rows") - 1).alias("rows"))))
        split = meet.select(*used, copies.alias("_c")).where("_c.rows > 0 AND size(_c.failed) > 0")
        out = out.unionByName(split.select(*used, "_c.failed", "_c.rows"))
    return out.select(F.lit(table).alias("table"), *used, F.array_sort("failed").alias("failed"), "rows")
