"""Data quality: table counts, declared-constraint checks, column defaults.

The reference declares PRIMARY KEY, UNIQUE, NOT NULL, CHECK ... IN and
REFERENCES rules and lets the database enforce some of them on insert. Here
they are a check job over tables of any size: the rules on a table's single rows
share one aggregate, each key rule is one aggregate or anti join, and the results
(one row per rule) are unioned.

Violation counts:
  pk / unique   rows beyond the first per key value (NULL keys: pk counts
                them, unique ignores them, as in SQL)
  not_null      rows with the column NULL (one result row per column)
  check_in      rows with a non-NULL value outside the allowed set
  fk            rows with a non-NULL key that has no parent row
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.sources import schema as S


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) for every table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _column_rules(df: DataFrame, table: str, rules: list[tuple]) -> DataFrame | None:
    """All rules on single rows of one table (not_null, check_in, NULL keys) in one aggregate over it."""
    found = []

    def rule(kind: str, cols, bad: Column | None) -> None:
        count = F.lit(None).cast("bigint") if bad is None else F.count(F.when(bad, 1))
        found.append((kind, ",".join(cols), count))

    for kind, cols, arg in rules:
        if kind == "pk":
            rule("pk_not_null", cols, reduce(or_, [F.col(c).isNull() for c in cols]))
        elif kind == "not_null":   # a column the frame lacks is reported as not checked
            for c in cols:
                rule(kind, [c], F.col(c).isNull() if c in df.columns else None)
        elif kind == "check_in":
            c = F.col(cols[0])
            rule(kind, cols, c.isNotNull() & ~c.isin(list(arg)))
    if not found:
        return None
    counted = df.agg(*[c.alias(f"v{i}") for i, (_, _, c) in enumerate(found)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(table).alias("table"), F.lit(kind).alias("rule"), F.lit(cols).alias("columns"),
                 F.col(f"v{i}").alias("violations"), F.col(f"v{i}").isNotNull().alias("checked"))
        for i, (kind, cols, _) in enumerate(found)])))


def _result(table: str, rule: str, cols, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"),
                          F.lit(",".join(cols)).alias("columns"),
                          F.col("violations").cast("bigint").alias("violations"), F.lit(True).alias("checked"))


def _key_rule(tables: dict[str, DataFrame], table: str, kind: str, cols, arg) -> DataFrame | None:
    """One job for each pk, unique and fk rule."""
    df = tables[table]
    keys = [F.col(c) for c in cols]
    if kind in ("pk", "unique"):
        keyed = df.select(*keys)
        if kind == "unique":   # rows with a NULL key part never collide
            keyed = keyed.where(reduce(and_, [k.isNotNull() for k in keys]))
        return _result(table, kind, cols, keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("c"))
                       .agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("violations")))
    if kind == "fk":
        parent_table, parent_col = arg
        parent = tables[parent_table].select(F.col(parent_col).alias("_parent")).distinct()
        child = df.select(keys[0].alias("_child")).where(F.col("_child").isNotNull())
        orphans = child.join(parent, child._child == parent._parent, "left_anti")
        return _result(table, "fk", cols, orphans.agg(F.count(F.lit(1)).alias("violations")))
    if kind not in ("not_null", "check_in"):
        raise ValueError(f"unknown rule kind {kind}")
    return None


def constraint_violations(tables: dict[str, DataFrame], rules=None) -> DataFrame:
    """One row per rule: table, rule, columns, violations, checked (false, with no count, if a column is missing)."""
    rules = [r for r in (rules or S.RULES) if r[0] in tables]
    parts = [_column_rules(tables[t], t, [r[1:] for r in rules if r[0] == t]) for t in dict.fromkeys(r[0] for r in rules)]
    parts += [_key_rule(tables, *r) for r in rules]
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """Add a declared DEFAULT column that the frame lacks (a stored NULL stays NULL)."""
    target = {f.name: f.dataType for f in S.TABLES[table].fields}
    for col, value in S.DEFAULTS.get(table, {}).items():
        if col not in df.columns:
            df = df.withColumn(col, F.lit(value).cast(target[col]))
    return df
