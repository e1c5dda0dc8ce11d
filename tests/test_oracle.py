"""Every registered query against its DuckDB SQL on the sf0.001 tables.

Same comparison as the driver's: column names, row count, and the multiset
of rows (exact values, order ignored).
"""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as E
from tillroll.plans.catalog import all_queries
from tillroll.plans.oracle import SQL

SF = "/root/testdata/sf0.001"
KEYS = sorted(SQL)
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows, order):
    idx = [cols.index(c) for c in order]
    return sorted(tuple(_norm(r[i]) for i in idx) for r in rows)


def test_every_query_has_sql():
    assert set(all_queries()) == set(SQL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {E.oracle_sql()[key]}").fetchall()}
    for f in df.schema.fields:
        spark_type = f.dataType.simpleString()
        assert TYPES.get(spark_type, spark_type) == duck_types[f.name], (f.name, spark_type)
    assert len(got) == len(want)
    order = sorted(cols)
    assert _rows(cols, got, order) == _rows(ocols, want, order)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["month", "total_orders", "unique_customers", "net_revenue",
                          "gross_profit", "profit_margin_pct", "mom_growth"]
