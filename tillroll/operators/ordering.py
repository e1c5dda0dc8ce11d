"""Exact global order statistics without an unpartitioned window.

``RANK() OVER (ORDER BY v)``, ``ROW_NUMBER``, ``NTILE`` and a running ``SUM``
over an unpartitioned window make Spark move every row into one task
(``Exchange SinglePartition``). Here the same numbers are computed with the
rows spread over many tasks:

1. Job 1 (one aggregate; a few numbers reach the driver): approximate
   quantiles of each sort key, row count and NULL count. Quantiles only decide
   how rows are spread, never a result: any boundaries give exact answers,
   good ones balance the tasks.
2. A key value that fills several quantile slots is *heavy* (it holds about
   that many slots' worth of rows, up to a third of all rows or more). Job 2
   gives each heavy value, and a large NULL group, as many tie-break ranges
   as it has slots, from tie-break quantiles inside that value.
3. Each row gets a bucket from a pure expression: a binary search of its key
   among the boundaries (a key equal to a boundary gets a "point" bucket of
   its own), plus the tie-break range for heavy values. Buckets follow the
   output order, there are at most about three per quantile slot, and a
   recomputed task puts a row in the same bucket.
4. Job 3: row count and key sum per bucket (one small row per bucket);
   prefix sums over them give every bucket's offsets (a bounded literal map).
5. ``Window.partitionBy(bucket).orderBy(key, tiebreak)`` numbers rows inside a
   bucket and the offsets make the numbers global.

RANK needs no tie-break: equal keys share one interval bucket, or form a
point value whose rank is the rows before it plus one. Without a tie-break
column heavy values are split by a hash of the row: tasks stay balanced and
ranks exact, while row numbers follow an arbitrary order among ties.

LAG needs the last row before a bucket only, which one aggregate finds (:func:`global_lag`).

Several orderings of the same rows (the three RFM tiles) share jobs 1-3 and
chain their windows on one DataFrame: one shuffle per ordering, no joins.
"""

from __future__ import annotations

import math
import warnings
from collections import Counter
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.dates import epoch_micros
from tillroll.session import ensure_checkpoint_dir

_DIV = "div"
_SUM_TYPE = T.DecimalType(38, 10)
ROWS_PER_BUCKET = 100_000


@dataclass(frozen=True)
class OrderSpec:
    """One ordering: ``key`` ASC or DESC; NULLs placed as Spark does unless given."""
    key: str
    descending: bool = False
    nulls_first: bool | None = None
    prefix: str = ""
    sum_col: str | None = None

    @property
    def nulls_go_first(self) -> bool:
        return (not self.descending) if self.nulls_first is None else self.nulls_first


def default_buckets(df: DataFrame) -> int:
    """Two buckets per shuffle partition, at least 16."""
    try:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - the conf is always set
        parts = 200
    return max(16, 2 * parts)


def checkpointed(df: DataFrame, wanted: bool = True) -> DataFrame:
    """Reliable checkpoint to ``spark.checkpoint.dir`` when one is configured."""
    if not wanted:
        return df
    if not ensure_checkpoint_dir(df.sparkSession):
        warnings.warn("spark.checkpoint.dir is not set: the input of a global ordering is "
                      "not materialised (results stay exact, upstream work repeats)")
        return df
    return df.checkpoint(eager=True)


# --- SQL literals ------------------------------------------------------------

def _lit(v, dtype: T.DataType) -> str:
    t = dtype.simpleString()
    if v is None:
        return f"CAST(NULL AS {t})"
    if isinstance(dtype, T.DecimalType):
        return f"CAST('{Decimal(v)}' AS {t})"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"CAST('{float(v)!r}' AS {t})"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return f"CAST({int(v)} AS {t})"
    return f"CAST('{v}' AS {t})"


def _array(values, dtype: T.DataType) -> str:
    return f"CAST(array({', '.join(_lit(v, dtype) for v in values)}) AS array<{dtype.simpleString()}>)"


def _map(keys, values_sql: list[str], ktype: T.DataType, vtype: str) -> str:
    if not keys:
        return f"CAST(map() AS map<{ktype.simpleString()},{vtype}>)"
    return (f"map_from_arrays({_array(keys, ktype)}, "
            f"CAST(array({', '.join(values_sql)}) AS array<{vtype}>))")


def _lower_bound(arr: str, value: str, max_len: int) -> str:
    """SQL: number of elements of sorted array ``arr`` that are < ``value`` (binary search)."""
    steps = max(1, math.ceil(math.log2(max_len + 1)) + 1)
    mid = "CAST((acc.lo + acc.hi) div 2 AS INT)"
    return (f"aggregate(sequence(1, {steps}), named_struct('lo', 0, 'hi', coalesce(size({arr}), 0)), "
            f"(acc, i) -> IF(acc.lo < acc.hi, IF(element_at({arr}, {mid} + 1) < {value}, "
            f"named_struct('lo', {mid} + 1, 'hi', acc.hi), named_struct('lo', acc.lo, 'hi', {mid})), "
            f"acc), acc -> acc.lo)")


_TREE_MAX = 1024


def _lower_bound_col(values: list, col: str, dtype: T.DataType, arr_sql: str) -> Column:
    """Number of ``values`` (sorted, distinct) that are < ``col``.

    Up to ``_TREE_MAX`` boundaries this is a balanced CASE tree over literals
    (whole-stage code generation, no per-row allocation); beyond that the
    binary search runs as a higher-order function over the literal array.
    """
    if len(values) > _TREE_MAX:
        return F.expr(_lower_bound(arr_sql, col, len(values)))
    lits = [F.expr(_lit(v, dtype)) for v in values]
    v = F.col(col)

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(v > lits[mid], tree(mid + 1, hi)).otherwise(tree(lo, mid))
    return tree(0, len(values))


def _even_pick(qs: list, ranges: int) -> list:
    """``ranges - 1`` evenly spaced elements of a quantile list (distinct, sorted)."""
    if not qs or ranges < 2:
        return []
    n = len(qs) + 1
    return sorted({qs[min(len(qs) - 1, max(0, round(j * n / ranges) - 1))] for j in range(1, ranges)})


# --- planning: three small jobs shared by all orderings of one input --------

@dataclass
class _Plan:
    spec: OrderSpec
    sort_col: str
    bucket_col: str
    bucket: Column
    width: int
    row_off: str = ""
    rank_off: str = ""
    sum_off: str | None = None
    n: int = 0
    grand_total: object = None
    starts: list = field(default_factory=list)   # (bucket, rows before it, its rows), in order


def _plan(base: DataFrame, specs: list[OrderSpec], tiebreak: str | None, buckets: int,
          tag: str, materialize: bool = False) -> tuple[DataFrame, list[_Plan]]:
    b = buckets
    probs = [i / b for i in range(1, b)]
    accuracy = max(10000, 20 * b)
    cols = [f"_{tag}k{i}" for i in range(len(specs))]
    work = base.select("*", *[(-F.col(s.key) if s.descending else F.col(s.key)).alias(c)
                              for s, c in zip(specs, cols)])
    types = [work.schema[c].dataType for c in cols]
    tie_type = work.schema[tiebreak].dataType if tiebreak else None

    # Job 1: quantiles, row count and NULL count of every sort key. When the
    # input is materialised they are observed while the checkpoint is written.
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        aggs += [F.percentile_approx(c, probs, accuracy).alias(f"q{i}"),
                 F.count(F.when(F.col(c).isNull(), 1)).alias(f"z{i}")]
    if materialize and ensure_checkpoint_dir(work.sparkSession):
        seen = Observation()
        work = work.observe(seen, *aggs).checkpoint(eager=True)
        row = seen.get
    else:
        if materialize:
            warnings.warn("spark.checkpoint.dir is not set: the input of a global ordering is "
                          "not materialised (results stay exact, upstream work repeats)")
        row = work.agg(*aggs).first().asDict()
    n = row["n"]
    # Thin the boundaries when the input is small: about one bucket per
    # ROWS_PER_BUCKET rows, never fewer than 16, never more than planned.
    wanted_b = min(b, max(16, -(-n // ROWS_PER_BUCKET)))
    quantiles = [_exact_heavy(work, c, t, row[f"q{i}"] or []) for i, (c, t) in enumerate(zip(cols, types))]
    if wanted_b < b:
        pick = [round(j * b / wanted_b) - 1 for j in range(1, wanted_b)]
        quantiles = [[q[k] for k in pick if k < len(q)] for q in quantiles]
        b = wanted_b
        probs = [i / b for i in range(1, b)]
    slot = max(1, n // b)
    layout = []
    for i in range(len(specs)):
        counts = Counter(v for v in quantiles[i] if v is not None)
        distinct = sorted(counts)
        heavy = {v: c for v, c in counts.items() if c >= 2}
        nulls = row[f"z{i}"]
        null_ranges = min(b, -(-nulls // slot)) if nulls > slot else 1
        layout.append((distinct, heavy, null_ranges))

    # Job 2: tie-break boundaries inside heavy values and a large NULL group.
    splits = [dict() for _ in specs]
    null_splits = [[] for _ in specs]
    wanted = [i for i, (_, h, z) in enumerate(layout) if tiebreak and (h or z > 1)]
    if wanted:
        parts = []
        for i in wanted:
            distinct, heavy, null_ranges = layout[i]
            c = F.col(cols[i])
            cond = c.isin(list(heavy)) if heavy else F.lit(False)
            if null_ranges > 1:
                cond = cond | c.isNull()
            parts.append(work.where(cond).groupBy(c.cast("string").alias("v"))
                         .agg(F.percentile_approx(tiebreak, probs, accuracy).alias("q"))
                         .select(F.lit(i).alias("i"), "v", "q"))
        union = parts[0]
        for p in parts[1:]:
            union = union.unionByName(p)
        # at most (#heavy values + 1) rows per ordering, each holding < b numbers
        by_text = [{str(k): k for k in layout[i][1]} for i in range(len(specs))]
        for r in union.collect():
            i = r["i"]
            distinct, heavy, null_ranges = layout[i]
            q = [x for x in (r["q"] or []) if x is not None]
            if r["v"] is None:
                null_splits[i] = _even_pick(q, null_ranges)
            else:
                key = by_text[i].get(r["v"])
                if key is None:
                    key = _match(heavy, r["v"], types[i])
                if key is not None:
                    splits[i][key] = _even_pick(q, heavy[key])

    # Bucket expressions.
    plans = []
    for i, (s, c) in enumerate(zip(specs, cols)):
        distinct, heavy, null_ranges = layout[i]
        m = len(distinct)
        arr = _array(distinct, types[i])
        lb = _lower_bound_col(distinct, c, types[i], arr)
        is_point = (F.coalesce((lb < F.lit(m)) & (F.try_element_at(F.expr(arr), lb + 1) == F.col(c)),
                               F.lit(False)) if m else F.lit(False))
        if tiebreak:
            width = max([len(v) for v in splits[i].values()] + [len(null_splits[i]), 0]) + 1
            submap = _map(list(splits[i]), [_array(splits[i][k], tie_type) for k in splits[i]],
                          types[i], f"array<{tie_type.simpleString()}>")
            sub_point = F.expr(f"coalesce({_lower_bound(f'try_element_at({submap}, {c})', tiebreak, width)}, 0)")
            sub_null = F.expr(_lower_bound(_array(null_splits[i], tie_type), tiebreak, width))
        else:
            width = max(list(heavy.values()) + [null_ranges, 1])
            ways = _map(list(heavy), [str(heavy[k]) for k in heavy], types[i], "int")
            h = F.xxhash64(*[F.col(x) for x in base.columns])
            sub_point = F.coalesce(F.pmod(h, F.expr(f"try_element_at({ways}, {c})")), F.lit(0))
            sub_null = F.pmod(h, F.lit(null_ranges))
        null_v = F.lit(-1) if s.nulls_go_first else F.lit(2 * m + 1)
        vidx = F.when(F.col(c).isNull(), null_v).when(is_point, lb * 2 + 1).otherwise(lb * 2)
        sub = F.when(F.col(c).isNull(), sub_null).when(is_point, sub_point).otherwise(F.lit(0))
        bucket = vidx.cast("long") * F.lit(width).cast("long") + sub.cast("long")
        plans.append(_Plan(s, c, f"_{tag}b{i}", bucket, width, n=n))

    # Job 3: rows and key sums per bucket, every ordering at once.
    entries = []
    for i, p in enumerate(plans):
        sval = (F.col(p.spec.sum_col).cast(_SUM_TYPE) if p.spec.sum_col
                else F.lit(None).cast(_SUM_TYPE))
        entries.append(F.struct(F.lit(i).alias("i"), p.bucket.alias("b"), sval.alias("s")))
    stats = (work.select(F.explode(F.array(*entries)).alias("e"))
             .groupBy(F.col("e.i").alias("i"), F.col("e.b").alias("b"))
             .agg(F.count(F.lit(1)).alias("c"), F.sum("e.s").alias("s"))
             .collect())   # about three rows per quantile slot and ordering
    per: dict[int, list] = {i: [] for i in range(len(plans))}
    for r in stats:
        per[r["i"]].append((r["b"], r["c"], r["s"]))
    for i, p in enumerate(plans):
        rows = sorted(per[i])
        by_value: dict[int, int] = {}
        for bk, cnt, _ in rows:
            by_value[bk // p.width] = by_value.get(bk // p.width, 0) + cnt
        before_value, acc = {}, 0
        for v in sorted(by_value):
            before_value[v] = acc
            acc += by_value[v]
        keys, row_off, rank_off, sum_off = [], [], [], []
        acc_rows, acc_sum = 0, None
        for bk, cnt, sm in rows:
            keys.append(bk)
            p.starts.append((bk, acc_rows, cnt))
            row_off.append(acc_rows)
            rank_off.append(before_value[bk // p.width])
            sum_off.append(acc_sum)
            acc_rows += cnt
            if sm is not None:
                acc_sum = sm if acc_sum is None else acc_sum + sm
        p.row_off = _map(keys, [str(x) for x in row_off], T.LongType(), "bigint")
        p.rank_off = _map(keys, [str(x) for x in rank_off], T.LongType(), "bigint")
        if p.spec.sum_col:
            p.sum_off = _map(keys, [_lit(x, _SUM_TYPE) for x in sum_off], T.LongType(),
                             _SUM_TYPE.simpleString())
            p.grand_total = acc_sum
    return work, plans


def _exact_heavy(work: DataFrame, key: str, dtype: T.DataType, quantiles: list) -> list:
    """Quantiles with the heavy values among them made exact.

    ``percentile_approx`` computes in DOUBLE, so a decimal of more than 15 digits
    comes back a little off and would not be recognised as the hot value it stands for. The most frequent value
    within the rounding error takes its place (one small aggregate, only where that can happen).
    """
    near = [v for v, c in Counter(quantiles).items()
            if isinstance(dtype, T.DecimalType) and c >= 2 and len(v.as_tuple().digits) > 15]
    exact = {}
    for v in near:
        slack = abs(v) / 2**51
        lo, hi = (F.lit(str(x)).cast("decimal(38,10)") for x in (v - slack, v + slack))
        top = (work.where(F.col(key).between(lo, hi)).groupBy(key).count()
               .orderBy(F.col("count").desc(), key).limit(1).collect())
        if top:
            exact[v] = top[0][0]
    return [exact.get(v, v) for v in quantiles]


def _match(heavy: dict, text: str, dtype: T.DataType):
    for k in heavy:
        if str(k) == text:
            return k
        try:
            if isinstance(dtype, T.DecimalType) and Decimal(text) == Decimal(k):
                return k
            if isinstance(dtype, (T.FloatType, T.DoubleType)) and float(text) == float(k):
                return k
            if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) \
                    and int(text) == int(k):
                return k
        except (ValueError, ArithmeticError):
            continue
    return None


# --- public operators ----------------------------------------------------------

def global_orders(df: DataFrame, specs: list[OrderSpec], *, tiebreak: str | None = None,
                  buckets: int | None = None, materialize: bool = True,
                  tag: str = "o") -> DataFrame:
    """Add, per spec, exact global ``{prefix}row_number``, ``{prefix}rank``,
    ``{prefix}n`` and, with ``sum_col``, ``{prefix}running_sum`` (ROWS frame up
    to the current row) and ``{prefix}grand_total``.

    Order: ``key`` then ``tiebreak`` ASC. The input is read by up to three
    small jobs and the final plan; with ``materialize`` it is first
    checkpointed to the shared folder named by ``spark.checkpoint.dir`` (the
    quantiles are observed during that write), so its upstream runs once.
    """
    b = buckets or default_buckets(df)
    work, plans = _plan(df, specs, tiebreak, b, tag, materialize)
    out = work
    drop = []
    for p in plans:
        s = p.spec
        order = F.col(p.sort_col).asc_nulls_first() if s.nulls_go_first else F.col(p.sort_col).asc_nulls_last()
        w = Window.partitionBy(p.bucket_col).orderBy(order, *([F.col(tiebreak).asc()] if tiebreak else []))
        peers = Window.partitionBy(p.bucket_col).orderBy(order)
        out = (out.withColumn(p.bucket_col, p.bucket)
               .withColumn(f"{s.prefix}row_number",
                           F.expr(f"try_element_at({p.row_off}, {p.bucket_col})") + F.row_number().over(w))
               .withColumn(f"{s.prefix}rank",
                           F.expr(f"try_element_at({p.rank_off}, {p.bucket_col})") + F.rank().over(peers))
               .withColumn(f"{s.prefix}n", F.lit(p.n).cast("long")))
        if s.sum_col:
            inside = F.sum(s.sum_col).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            before = F.expr(f"try_element_at({p.sum_off}, {p.bucket_col})")
            run = (F.when(before.isNull(), inside).when(inside.isNull(), before)
                   .otherwise(before + inside))
            grand = p.grand_total
            out = (out.withColumn(f"{s.prefix}running_sum", run)
                   .withColumn(f"{s.prefix}grand_total",
                               F.expr(_lit(grand, _SUM_TYPE)) if grand is not None
                               else F.lit(None).cast(_SUM_TYPE)))
        drop += [p.sort_col, p.bucket_col]
    return out.drop(*drop)


def global_order(df: DataFrame, key: str, *, descending: bool = False,
                 nulls_first: bool | None = None, tiebreak: str | None = None,
                 prefix: str = "", sum_col: str | None = None, buckets: int | None = None,
                 materialize: bool = True) -> DataFrame:
    """One ordering; see :func:`global_orders`."""
    spec = OrderSpec(key, descending, nulls_first, prefix, sum_col)
    return global_orders(df, [spec], tiebreak=tiebreak, buckets=buckets, materialize=materialize)


def ntile_of(row_number: Column, n: Column, tiles: int) -> Column:
    """NTILE(tiles) from a global 1-based row number and the row count.

    The first ``n mod tiles`` tiles hold one row more, as in SQL.
    """
    q = F.call_function(_DIV, n, F.lit(tiles).cast("long"))
    r = n % F.lit(tiles)
    big = r * (q + 1)
    first = F.call_function(_DIV, row_number - 1, q + 1) + 1
    rest = r + F.call_function(_DIV, row_number - 1 - big, F.greatest(q, F.lit(1).cast("long"))) + 1
    return F.when(row_number <= big, first).otherwise(rest).cast("long")


def global_ntiles(df: DataFrame, specs: list[tuple[str, bool, str]], tiles: int, *,
                  tiebreak: str, buckets: int | None = None,
                  materialize: bool = True) -> DataFrame:
    """Several ``NTILE(tiles) OVER (ORDER BY key [DESC], tiebreak)`` at once.

    ``specs``: (key, descending, output column); ``tiebreak`` is unique. A tile ends at a
    known row number, which the bucket counts place in one bucket: the (key,
    tiebreak) there is read off the few buckets that hold a tile's end, and every
    row's tile is then a CASE over those at most ``tiles - 1`` pairs. No row outside these
    buckets is shuffled.
    """
    order_specs = [OrderSpec(k, d, prefix=f"_nt{i}_") for i, (k, d, _) in enumerate(specs)]
    work, plans = _plan(df, order_specs, tiebreak, buckets or default_buckets(df), "nt", materialize)
    ends = [tile_ends(p.n, tiles) for p in plans]
    cuts = _rows_at(work, plans, ends, tiebreak)
    out = work
    for i, (p, (_, _, name)) in enumerate(zip(plans, specs)):
        tile = F.lit(tiles)
        for t in reversed(range(1, tiles)):
            key_and_tie = cuts.get((i, ends[i][t - 1]))
            if key_and_tie is not None:
                tile = F.when(_not_after(p, key_and_tie, tiebreak, work.schema), t).otherwise(tile)
        out = out.withColumn(name, tile.cast("long"))
    return out.drop(*[p.sort_col for p in plans])


def tile_ends(n: int, tiles: int) -> list[int]:
    """Number of the last row of each tile but the last; the first ``n mod tiles`` tiles hold one row more."""
    q, r = divmod(n, tiles)
    return [t * q + min(t, r) for t in range(1, tiles)]


def _rows_at(work: DataFrame, plans: list[_Plan], ends: list[list[int]], tiebreak: str) -> dict:
    """{(plan, row number): (key, tiebreak)} of the wanted rows, from the buckets that hold them."""
    parts = []
    for i, p in enumerate(plans):
        wanted = {}   # bucket -> row numbers inside it
        for end in {e for e in ends[i] if e > 0}:
            bucket, before, _ = next(x for x in p.starts if x[1] < end <= x[1] + x[2])
            wanted.setdefault(bucket, {})[end - before] = end
        if not wanted:
            continue
        order = F.col("key").asc_nulls_first() if p.spec.nulls_go_first else F.col("key").asc_nulls_last()
        inside = (work.select(p.bucket.alias("b"), F.col(p.sort_col).alias("key"), F.col(tiebreak).alias("tie"))
                  .where(F.col("b").isin(list(wanted)))
                  .withColumn("row", F.row_number().over(Window.partitionBy("b").orderBy(order, "tie"))))
        pick = F.lit(None).cast("long")
        for bucket, rows in wanted.items():
            for row, end in rows.items():
                pick = F.when((F.col("b") == bucket) & (F.col("row") == row), F.lit(end).cast("long")).otherwise(pick)
        parts.append(inside.withColumn("end", pick).where("end IS NOT NULL")
                     .select(F.lit(i).alias("i"), "end", F.col("key").cast("string").alias("key"), "tie"))
    found = {}
    for part in parts:   # at most tiles - 1 rows each
        found.update({(r["i"], r["end"]): (r["key"], r["tie"]) for r in part.collect()})
    return found


def _not_after(p: _Plan, cut: tuple, tiebreak: str, schema: T.StructType) -> Column:
    """Whether a row's (key, tiebreak) is at or before ``cut`` in the plan's order."""
    key, tie = cut
    k = F.col(p.sort_col)
    same_tie = F.col(tiebreak) <= F.expr(_lit(tie, schema[tiebreak].dataType))
    if key is None:
        return k.isNull() & same_tie if p.spec.nulls_go_first else k.isNotNull() | same_tie
    c = F.lit(key).cast(schema[p.sort_col].dataType)
    before = F.coalesce((k < c) | ((k == c) & same_tie), F.lit(False))
    return k.isNull() | before if p.spec.nulls_go_first else before


def global_ntile(df: DataFrame, key: str, tiles: int, out: str, *, descending: bool = False,
                 tiebreak: str, buckets: int | None = None, materialize: bool = True) -> DataFrame:
    """``NTILE(tiles) OVER (ORDER BY key [DESC], tiebreak)`` without one partition."""
    return global_ntiles(df, [(key, descending, out)], tiles, tiebreak=tiebreak,
                         buckets=buckets, materialize=materialize)


def global_lag(df: DataFrame, key: str, values: dict[str, str], *, tiebreak: str, descending: bool = False,
               nulls_first: bool | None = None, buckets: int | None = None, materialize: bool = True) -> DataFrame:
    """``LAG(value) OVER (ORDER BY key [DESC], tiebreak)`` without one partition, for several values at once.

    ``values`` maps columns to the names of their previous row's values (NULL in the first row).
    ``tiebreak`` is unique. Inside a bucket a window gives them; a bucket's first row takes those of the last row before the
    bucket, which one aggregate finds: the last row of every bucket, about three a quantile slot, is all that leaves the executors.
    """
    spec = OrderSpec(key, descending, nulls_first)
    # a time is ordered by its microseconds, exactly
    dtype = df.schema[key].dataType
    by = "_lagkey"
    number = _as_number(F.col(key), dtype)
    base = df.withColumn(by, number)
    work, (p,) = _plan(base, [replace(spec, key=by)], tiebreak, buckets or default_buckets(df), "lag", materialize)
    order = F.col(p.sort_col).asc_nulls_first() if spec.nulls_go_first else F.col(p.sort_col).asc_nulls_last()
    # a bucket's keys are all NULL or all not, so the greatest (key, tiebreak) is its last row
    last = (work.groupBy(p.bucket.alias("b"))
            .agg(F.max_by(F.struct(*[F.col(c) for c in values]), F.struct(F.col(p.sort_col), F.col(tiebreak))).alias("v"))
            .collect())
    rows, before = [], None
    for r in sorted(last, key=lambda r: r["b"]):
        if before is not None:
            rows.append((r["b"], *before))
        before = tuple(r["v"])
    carry_type = T.StructType([T.StructField("_lagb", T.LongType()), *[
        T.StructField(f"_carry{i}", work.schema[c].dataType) for i, c in enumerate(values)]])
    carried = F.broadcast(df.sparkSession.createDataFrame(rows, carry_type))     # one row a bucket
    out = work.withColumn("_lagb", p.bucket).join(carried, "_lagb", "left")
    w = Window.partitionBy("_lagb").orderBy(order, F.col(tiebreak).asc())
    out = out.withColumn("_lagrow", F.row_number().over(w))
    for i, (c, name) in enumerate(values.items()):
        out = out.withColumn(name, F.when(F.col("_lagrow") == 1, F.col(f"_carry{i}")).otherwise(F.lag(c).over(w)))
    return out.select(*df.columns, *values.values())


def _as_number(c: Column, dtype: T.DataType) -> Column:
    """The column as a number of the same order (dates and times have no quantiles of their own)."""
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return epoch_micros(c).cast("bigint")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c)
    return c
