"""Skew-safe ordered scans: row numbers and directional fills within groups.

A plain ``row_number().over(Window.partitionBy(key).orderBy(...))`` sends every
row of a key to one task.  When one key holds a third of the data (one
declaration covering every county, one busy month in one state) that task runs
alone.  Here the rows are *range-partitioned* on (keys, full order) and written
once to the shared checkpoint folder with the number of their range:

1. Spark samples the whole key tuple, so a hot key is cut wherever its rows
   are, whatever the types, directions and shapes of the order columns; only
   rows equal in every order column stay together.
2. The written table fixes the ranges: a retried task or a second branch of
   the plan reads the same files, so it sees the same ranges, and the input is
   evaluated once (plus Spark's sampling pass).
3. The scan runs per (key, range) with a running window.
4. Only a key that crosses a range border needs offsets or carried values, and
   there are at most two such (key, range) rows per range; carried values are joined
   back by an ordinary join whose strategy Spark picks by measured size, offsets (one row a
   range) are broadcast.

``skew_safe=False`` falls back to the single window (one shuffle) for callers
that know their groups are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

RANGE = "__range"
INDEX = "__index"


def _spec(item: str) -> tuple[str, bool, bool]:
    """``"name [asc|desc] [nulls first|last]"`` -> (name, ascending, nulls_first)."""
    parts = item.split()
    name, rest = parts[0], [p.lower() for p in parts[1:]]
    asc = "desc" not in rest
    if "nulls" in rest:
        nulls_first = rest[rest.index("nulls") + 1] == "first"
    else:
        nulls_first = asc  # Spark's default: NULLs sort as the smallest value
    return name, asc, nulls_first


def _sorted(name: str, asc: bool, nulls_first: bool) -> Column:
    c = F.col(name)
    if asc:
        return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()
    return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()


def _order_cols(order: list[str | Column], reverse: bool = False) -> list[Column]:
    out = []
    for o in order:
        if isinstance(o, str):
            name, asc, nf = _spec(o)
            out.append(_sorted(name, not asc, not nf) if reverse else _sorted(name, asc, nf))
        elif reverse:
            raise ValueError("reversible order needs text specs such as 'col desc nulls last'")
        else:
            out.append(o)
    return out


def ranged(df: DataFrame, keys: list[str], order: list[str | Column], partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted on (keys, order), written once with
    ``__range`` (number of the range; ranges follow the order) and ``__index``
    (position inside the range, from 0)."""
    cols = [F.col(k).asc_nulls_first() for k in keys] + _order_cols(order)
    t = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    t = t.sortWithinPartitions(*cols)
    # monotonically_increasing_id: the row's position in its partition is its low 33 bits
    index = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return materialize(t.withColumn(RANGE, F.spark_partition_id()).withColumn(INDEX, index), "ranged")


def range_offsets(staged: DataFrame, keys: list[str], value: Column | None = None) -> DataFrame:
    """Per (keys, range): the sum of ``value`` (default: rows) of the same key in
    all earlier ranges, as ``__off``.  One row per key and range."""
    total = staged.groupBy(*keys, RANGE).agg(F.sum(value if value is not None else F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return total.select(*keys, RANGE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))


def number_within(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    out: str = "rn",
    skew_safe: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """``row_number()`` (BIGINT) within ``keys`` by ``order`` (1-based), hot keys split."""
    if not skew_safe:
        w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
        return df.withColumn(out, F.row_number().over(w).cast("long"))
    t = ranged(df, keys, order, partitions)
    local = t.withColumn("__lrn", F.row_number().over(Window.partitionBy(*keys, RANGE).orderBy(INDEX)).cast("long"))
    return add_offsets(local, range_offsets(t, keys), keys, "__lrn", out).drop(RANGE, INDEX)


def number_flagged(df: DataFrame, keys: list[str], order: list[str | Column], flag: str, out: str = "rn") -> DataFrame:
    """How many rows with ``flag`` = 1 (else 0) come up to each row within ``keys`` by ``order``, hot keys split."""
    t = ranged(df, keys, order)
    upto = Window.partitionBy(*keys, RANGE).orderBy(INDEX).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = t.withColumn("__lrn", F.sum(flag).over(upto).cast("long"))
    return add_offsets(local, range_offsets(t, keys, F.col(flag)), keys, "__lrn", out).drop(RANGE, INDEX)


def add_offsets(local: DataFrame, offsets: DataFrame, keys: list[str], number: str, out: str) -> DataFrame:
    """``out`` = ``number`` plus the positive offset of its (keys, range).

    Only the first key of a range can go on from an earlier one, so there is one row a range at most: it is sent to
    all tasks, and the numbered rows are not dealt out again."""
    crossing = offsets.filter(F.col("__off") > 0).select(F.col(RANGE).alias("__r_range"), *[F.col(k).alias(f"__r_{k}") for k in keys], "__off")
    same = F.col("__off").isNotNull()
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    joined = local.join(F.broadcast(crossing), F.col(RANGE) == F.col("__r_range"), "left")
    added = joined.withColumn(out, F.col(number) + F.when(same, F.col("__off")).otherwise(0))
    return added.drop(*{number} - {out}, "__off", "__r_range", *[f"__r_{k}" for k in keys])


def fill_within(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    col: str,
    direction: str = "updown",
    skew_safe: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Fill NULLs of ``col`` within ``keys`` in ``order``.

    ``down``: previous non-null; ``up``: next non-null; ``updown``: next, else
    previous; ``downup``: previous, else next.  Order items are column names
    with an optional direction, e.g. ``"emdatID asc nulls last"``.
    """
    if direction not in ("up", "down", "updown", "downup"):
        raise ValueError(direction)
    # Only running frames (UNBOUNDED PRECEDING .. CURRENT ROW) are used: Spark
    # evaluates them incrementally, while a frame reaching UNBOUNDED FOLLOWING
    # is re-aggregated per row (quadratic in the group size).  The look-ahead
    # is the running last non-null over the reversed order.
    oc, rc = _order_cols(order), _order_cols(order, reverse=True)
    running = (Window.unboundedPreceding, Window.currentRow)

    def both(t: DataFrame, part: list[str], fwd: list[Column], bwd: list[Column]) -> DataFrame:
        back = Window.partitionBy(*part).orderBy(*bwd).rowsBetween(*running)
        ahead = Window.partitionBy(*part).orderBy(*fwd).rowsBetween(*running)
        t = t.withColumn("__nxt", F.last(col, ignorenulls=True).over(back))
        return t.withColumn("__prv", F.last(col, ignorenulls=True).over(ahead))

    if not skew_safe:
        t = both(df, keys, oc, rc)
        return t.withColumn(col, _combine(F.col(col), F.col("__nxt"), F.col("__prv"), direction)).drop("__nxt", "__prv")

    t = ranged(df, keys, order, partitions)
    local = both(t, [*keys, RANGE], [F.col(INDEX)], [F.col(INDEX).desc()])
    # first / last non-null value of each (key, range), carried over the borders
    known = F.when(F.col(col).isNotNull(), F.col(INDEX))
    summary = t.groupBy(*keys, RANGE).agg(F.min_by(col, known).alias("__first"), F.max_by(col, known).alias("__last"))
    ws = Window.partitionBy(*keys).orderBy(RANGE)
    wsr = Window.partitionBy(*keys).orderBy(F.col(RANGE).desc())
    carry = summary.select(
        *keys,
        RANGE,
        F.last("__first", ignorenulls=True).over(wsr.rowsBetween(Window.unboundedPreceding, -1)).alias("__later"),
        F.last("__last", ignorenulls=True).over(ws.rowsBetween(Window.unboundedPreceding, -1)).alias("__earlier"),
    ).filter(F.col("__later").isNotNull() | F.col("__earlier").isNotNull())
    joined = join_null_safe(local, carry, [*keys, RANGE], "left")
    nxt = F.coalesce(F.col("__nxt"), F.col("__later"))
    prv = F.coalesce(F.col("__prv"), F.col("__earlier"))
    return joined.withColumn(col, _combine(F.col(col), nxt, prv, direction)).drop(
        RANGE, INDEX, "__nxt", "__prv", "__later", "__earlier"
    )


def join_null_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` where NULL matches NULL (grouping keys may be NULL).

    Spark plans ``<=>`` keys as an ordinary hash/sort-merge equi-join."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(r[f"__r_{c}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"__r_{c}" for c in cols])


def _combine(x: Column, nxt: Column, prv: Column, direction: str) -> Column:
    if direction == "up":
        return F.coalesce(x, nxt)
    if direction == "down":
        return F.coalesce(x, prv)
    if direction == "updown":
        return F.coalesce(x, nxt, prv)
    return F.coalesce(x, prv, nxt)


def with_group_stats(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Attach per-group aggregates to every row (``min(x) over (partition by k)``)
    as an aggregate + join: the aggregate combines map-side, and the join back
    is split by AQE when one key is hot, instead of one window task per key."""
    stats = df.groupBy(*keys).agg(*aggs)
    return join_null_safe(df, stats, keys)
