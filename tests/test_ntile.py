"""NTILE from (row number, row count): property test against SQL's definition."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.operators.ordering import ntile_of


def _sql_ntile(n: int, k: int) -> list[int]:
    q, r = divmod(n, k)
    out = []
    for tile in range(1, k + 1):
        out += [tile] * (q + 1 if tile <= r else q)
    return out


@settings(max_examples=15, deadline=None)
@given(n=st.integers(min_value=0, max_value=60), k=st.integers(min_value=1, max_value=12))
def test_ntile_matches_sql(spark, n, k):
    df = spark.range(1, n + 1).select(F.col("id").alias("rn"), F.lit(n).cast("long").alias("n"))
    got = [r[0] for r in df.orderBy("rn").select(ntile_of(F.col("rn"), F.col("n"), k)).collect()]
    assert got == _sql_ntile(n, k)
