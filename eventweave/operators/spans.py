"""Spans, days and matching.

A span is a row with ``begin_date`` / ``end_date``.  The reference explodes
every span into day rows and joins on the day; at scale that join is the
bottleneck (36M x 33M day rows).  Here matching runs on spans: an equi-join on
place + calendar bucket, then an interval test, and only the overlap of a
matched pair is expanded to days when day rows are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import INDEX, RANGE, fill_within, join_null_safe, number_within, range_offsets, ranged


def audit_spans(df: DataFrame, by: str = "incident_type", begin: str = "begin_date", end: str = "end_date") -> DataFrame:
    """Per group, rows, reversed spans and missing ends."""
    d = F.datediff(F.col(end), F.col(begin))
    return df.groupBy(by).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.count(F.when(d < 0, 1)).cast("long").alias("n_reversed"),
        F.count(F.when(F.col(end).isNull(), 1)).cast("long").alias("n_missing_end"),
    )


def impute_end(
    df: DataFrame,
    levels: list[list[str]],
    begin: str = "begin_date",
    end: str = "end_date",
    duration: str = "duration",
    out: str = "end_imputed",
) -> DataFrame:
    """Fill missing ends with a hierarchical mean duration.

    Level 1 fills a missing duration with the mean of the known durations of
    its level-1 group (e.g. state, year); level 2 fills what is still missing
    with the mean, over its level-2 group (e.g. state), of the level-1 filled
    values; the result is rounded half-to-even and added to the begin date.
    Only missing ends are replaced.

    Means are computed as grouped sums and counts (combined map-side) on a
    small per-finest-group summary, then joined back: no window holds a whole
    state in one task.
    """
    if len(levels) < 1:
        raise ValueError("at least one level")
    finest = levels[0]
    for lv in levels[1:]:
        if not set(lv) <= set(finest):
            raise ValueError("levels must nest: each later level a subset of the first")
    t = df.withColumn(duration, F.datediff(F.col(end), F.col(begin)).cast("double"))
    summ = t.groupBy(*finest).agg(
        F.sum(duration).alias("__s"), F.count(duration).alias("__k"), F.count(F.lit(1)).alias("__n")
    )
    # level 1: mean of known values in the finest group
    summ = summ.withColumn("__m1", F.col("__s") / F.nullif(F.col("__k"), F.lit(0)))
    # after level 1 a group contributes s + (n - k) * m1 over n rows when it had
    # any known value, else nothing (its rows stay missing)
    summ = summ.withColumn("__fs", F.when(F.col("__k") > 0, F.col("__s") + (F.col("__n") - F.col("__k")) * F.col("__m1")))
    summ = summ.withColumn("__fn", F.when(F.col("__k") > 0, F.col("__n")).otherwise(F.lit(0)))
    fill_cols = ["__m1"]
    for i, lv in enumerate(levels[1:], start=2):
        up = summ.groupBy(*lv).agg((F.sum("__fs") / F.nullif(F.sum("__fn"), F.lit(0))).alias(f"__m{i}"))
        summ = join_null_safe(summ, up, lv, "left")
        fill_cols.append(f"__m{i}")
    stats = summ.select(*finest, *fill_cols)
    j = join_null_safe(t, stats, finest, "left")
    filled = F.coalesce(F.col(duration), F.col("__m1"))
    for c in fill_cols[1:]:
        filled = F.coalesce(filled, F.col(c))
    days = F.bround(filled, 0).cast("int")
    return j.withColumn(out, F.coalesce(F.col(end), F.date_add(F.col(begin), days))).drop(*fill_cols)


def imputation_error(df: DataFrame, end: str = "end_date", imputed: str = "end_imputed") -> DataFrame:
    """Imputed end vs known end where the end was known (all zero when
    imputation never overwrites a known end)."""
    err = F.datediff(F.col(end), F.col(imputed))
    k = df.filter(F.col(end).isNotNull()).select(err.alias("error"))
    return k.agg(
        F.count(F.lit(1)).cast("long").alias("n_known"),
        F.min("error").alias("min_error"),
        F.max("error").alias("max_error"),
        F.count(F.when(F.col("error") != 0, 1)).cast("long").alias("n_nonzero"),
    )


def exclude(df: DataFrame, types: list[str], last_begin: str, type_col: str = "incident_type", begin: str = "begin_date") -> DataFrame:
    """Drop listed types and spans beginning after ``last_begin`` (two
    separate parameters; the reference's single filter does both)."""
    return df.filter(~F.col(type_col).isin(types) & (F.col(begin) <= F.lit(last_begin).cast("date")))


def expand_days(
    df: DataFrame,
    begin: str = "begin_date",
    end: str = "end_date",
    day: str = "Day",
    reversed_spans: str = "drop",
    keep_bounds: bool = False,
) -> DataFrame:
    """One row per day of the span, both ends included.

    ``reversed_spans``: ``drop`` (default) or ``swap``; rows without an end are
    dropped.  ``explode`` streams: a task's output grows with the span lengths
    but is never held in memory."""
    b, e = F.col(begin), F.col(end)
    if reversed_spans == "swap":
        lo, hi = F.least(b, e), F.greatest(b, e)
        src = df.filter(b.isNotNull() & e.isNotNull())
    elif reversed_spans == "drop":
        lo, hi = b, e
        src = df.filter(b.isNotNull() & e.isNotNull() & (e >= b))
    else:
        raise ValueError(reversed_spans)
    out = src.withColumn(day, F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))))
    return out if keep_bounds else out.drop(begin, end)


def _buckets(begin: Column, end: Column, unit: str) -> Column:
    step = {"month": "INTERVAL 1 MONTH", "year": "INTERVAL 1 YEAR", "week": "INTERVAL 7 DAY"}[unit]
    if unit == "week":
        lo, hi = F.date_trunc("week", begin).cast("date"), F.date_trunc("week", end).cast("date")
    else:
        lo, hi = F.trunc(begin, unit), F.trunc(end, unit)
    return F.sequence(lo, hi, F.expr(step))


def _bucket_of(d: Column, unit: str) -> Column:
    return F.date_trunc("week", d).cast("date") if unit == "week" else F.trunc(d, unit)


def _day_keys(begin: Column, end: Column, side: int) -> Column:
    """Keys of ``match_spans`` by day: even ones for ``a``'s first day and the days of ``b``, odd ones for ``b``'s first day and
    the later days of ``a``."""
    lo, hi = F.unix_date(begin).cast("long") * 2, F.unix_date(end).cast("long") * 2
    if side == 0:
        return F.concat(F.array(lo), F.when(lo < hi, F.sequence(lo + 3, hi + 1, F.lit(2).cast("long"))).otherwise(F.array().cast("array<long>")))
    return F.concat(F.sequence(lo, hi, F.lit(2).cast("long")), F.array(lo + 1))


def match_spans(
    a: DataFrame,
    b: DataFrame,
    place_keys: list[str],
    bucket: str = "month",
    null_safe_keys: list[str] | None = None,
    a_begin: str = "begin_date",
    a_end: str = "end_date",
    b_begin: str = "begin_date",
    b_end: str = "end_date",
) -> DataFrame:
    """Pairs of spans at the same place whose date ranges intersect.

    Each side is exploded into the calendar buckets it touches (months by
    default: a span of d days yields d/30 + 1 rows, not d), joined on place +
    bucket, filtered by ``a.begin <= b.end and b.begin <= a.end``, and each pair
    is kept only in the bucket holding the overlap's first day — so no
    ``distinct`` shuffle is needed.  ``a`` columns keep their names; ``b``
    columns (other than place keys) must not collide with them.

    ``bucket="day"`` is for short spans at busy places: an overlap begins on the first day of one of its spans, so ``a``'s first
    day is matched with the days of ``b``, and ``b``'s with the later days of ``a``.  A span of d days yields d + 1 rows, but
    the join forms the pairs of the result alone, each once, and no pair is tested.

    Adds ``overlap_begin``, ``overlap_end``, ``overlap_days``.
    """
    null_safe_keys = null_safe_keys or []
    ab, ae, bb, be = "__a_b", "__a_e", "__b_b", "__b_e"
    A = a.filter(F.col(a_end) >= F.col(a_begin)).withColumn(ab, F.col(a_begin)).withColumn(ae, F.col(a_end))
    by_day = bucket == "day"
    A = A.withColumn("__bucket", F.explode(_day_keys(F.col(ab), F.col(ae), 0) if by_day else _buckets(F.col(ab), F.col(ae), bucket)))
    B = b.filter(F.col(b_end) >= F.col(b_begin)).withColumn(bb, F.col(b_begin)).withColumn(be, F.col(b_end))
    B = B.withColumn("__bucket", F.explode(_day_keys(F.col(bb), F.col(be), 1) if by_day else _buckets(F.col(bb), F.col(be), bucket)))
    B = B.select(*[F.col(c).alias(f"__rk_{c}") if c in place_keys + ["__bucket"] else F.col(c) for c in B.columns])
    cond = A["__bucket"] == B["__rk___bucket"]
    for k in place_keys:
        cond = cond & (A[k].eqNullSafe(B[f"__rk_{k}"]) if k in null_safe_keys else (A[k] == B[f"__rk_{k}"]))
    ob, oe = F.greatest(F.col(ab), F.col(bb)), F.least(F.col(ae), F.col(be))
    if by_day:
        j = A.join(B, cond, "inner")
    else:
        j = A.join(B, cond & (A[ab] <= B[be]) & (B[bb] <= A[ae]), "inner").filter(F.col("__bucket") == _bucket_of(ob, bucket))
    j = j.withColumn("overlap_begin", ob).withColumn("overlap_end", oe)
    j = j.withColumn("overlap_days", (F.datediff(F.col("overlap_end"), F.col("overlap_begin")) + 1).cast("int"))
    return j.drop("__bucket", ab, ae, bb, be, *[f"__rk_{k}" for k in place_keys + ["__bucket"]])


def match_days(
    a: DataFrame,
    b: DataFrame,
    place_keys: list[str],
    day: str = "Day",
    null_safe_keys: list[str] | None = None,
    a_begin: str = "begin_date",
    a_end: str = "end_date",
    b_begin: str = "begin_date",
    b_end: str = "end_date",
    text: bool = False,
) -> DataFrame:
    """The day-level inner match (same day, same place) of two span sets.

    The result has a row for every pair and day, so at a busy place it outgrows the day rows of either side by far: both are
    exploded to days and joined on (day, place).  Every pair that is formed is a row of the result; nothing is tested or exploded
    on pairs.  ``text``: the day as ``yyyy-MM-dd`` text, formatted on the day rows of ``a`` instead of on pairs."""
    null_safe_keys = null_safe_keys or []

    def days(df: DataFrame, begin: str, end: str) -> DataFrame:
        d = df.filter(F.col(end) >= F.col(begin)).withColumn("__n", F.explode(F.sequence(F.unix_date(begin), F.unix_date(end))))
        return d.drop("begin_date", "end_date")

    A, B = days(a, a_begin, a_end), days(b, b_begin, b_end)
    as_day = F.date_from_unix_date("__n")
    A = A.withColumn(day, as_day.cast("string") if text else as_day)
    B = B.select(*[F.col(c).alias(f"__rk_{c}") if c in [*place_keys, "__n"] else F.col(c) for c in B.columns])
    cond = A["__n"] == B["__rk___n"]
    for k in place_keys:
        cond = cond & (A[k].eqNullSafe(B[f"__rk_{k}"]) if k in null_safe_keys else (A[k] == B[f"__rk_{k}"]))
    return A.join(B, cond, "inner").drop("__n", *[f"__rk_{k}" for k in [*place_keys, "__n"]])


def event_map(
    a_days: DataFrame,
    b_days: DataFrame,
    a_id: str = "femaID",
    b_id: str = "emdatID",
    keys: tuple[str, ...] = ("Day", "state", "county"),
    null_safe: tuple[str, ...] = ("county",),
    a_carry: tuple[str, ...] = (),
    b_carry: tuple[str, ...] = (),
    spans: tuple[str, str] | None = None,
) -> DataFrame:
    """Full outer match of two day tables on (Day, state, county), NULL
    county matching NULL county; keeps both ids, and the columns ``a_carry`` and ``b_carry`` of either side
    (their names differ), so that no pair has to be joined back to them.

    ``spans`` (begin, end): both sides are spans instead of day rows, matched without shuffling days
    (see :func:`_event_map_of_spans`); the result is that of their :func:`expand_days`.

    Written as two joins instead of one FULL OUTER join: ``a`` left-joined to ``b``, and
    the rows of ``b`` whose key ``a`` does not have.  AQE can split a skewed partition
    for both join types but not for a full outer join."""
    if spans:
        return _event_map_of_spans(a_days, b_days, a_id, b_id, keys, null_safe, a_carry, b_carry, spans)
    A = a_days.select(*keys, a_id, *a_carry)
    B = b_days.select(*[F.col(k).alias(f"__b_{k}") for k in keys], b_id, *b_carry)
    cond = None
    for k in keys:
        e = A[k].eqNullSafe(B[f"__b_{k}"]) if k in null_safe else (A[k] == B[f"__b_{k}"])
        cond = e if cond is None else cond & e
    with_a = A.join(B, cond, "left").select(*keys, a_id, b_id, *a_carry, *b_carry)
    only_b = B.join(A.select(*keys).distinct(), cond, "left_anti").select(
        *[F.col(f"__b_{k}").alias(k) for k in keys], F.lit(None).cast("string").alias(a_id), b_id,
        *[F.lit(None).cast(A.schema[c].dataType).alias(c) for c in a_carry], *b_carry,
    )
    return with_a.unionByName(only_b)


_BLOCK = 8  # days of a block; a mask has a bit for each


def block_pieces(df: DataFrame, begin: str, end: str) -> DataFrame:
    """Spans cut at the borders of blocks of eight days: ``__block`` and ``__mask``, the days of the block that the piece has."""
    lo, hi = F.unix_date(begin), F.unix_date(end)
    t = df.filter(F.col(end) >= F.col(begin)).withColumn("__lo", lo).withColumn("__hi", hi).drop(begin, end)
    t = t.withColumn("__block", F.explode(F.sequence(F.shiftright("__lo", 3), F.shiftright("__hi", 3))))
    first = F.greatest(F.col("__lo") - F.col("__block") * _BLOCK, F.lit(0))
    last = F.least(F.col("__hi") - F.col("__block") * _BLOCK, F.lit(_BLOCK - 1))
    t = t.withColumn("__first", first).withColumn("__last", last)
    return t.withColumn("__mask", F.expr("shiftleft(2, __last) - shiftleft(1, __first)")).drop("__lo", "__hi", "__first", "__last")


def mask_days(mask: Column) -> Column:
    """The days of a mask as an array of their places in the block, looked up in a table of all masks."""
    table = F.array(*[F.array(*[F.lit(i) for i in range(_BLOCK) if m >> i & 1]).cast("array<int>") for m in range(1 << _BLOCK)])
    return F.get(table, mask)


def _event_map_of_spans(
    a: DataFrame, b: DataFrame, a_id: str, b_id: str, keys: tuple[str, ...], null_safe: tuple[str, ...],
    a_carry: tuple[str, ...], b_carry: tuple[str, ...], span: tuple[str, str],
) -> DataFrame:
    """:func:`event_map` of the days of two span tables, with one shuffle of either side and no day row in it.

    Spans are cut into blocks of eight days, pieces of a block and place are joined where they share a day, and the shared days of
    a pair are expanded above the join.  The days on which only one side has a span are
    found from one row a block and place: they make a piece without an id, added to the other side, so that one
    inner join, which AQE can split at a busy place, gives the full outer match.  Spans without a place match nothing."""
    day, *places = keys
    none = lambda df, names: [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in names]
    a_cols, b_cols = [a_id, *a_carry], [b_id, *b_carry]
    A, B = a.select(*places, *a_cols, *span), b.select(*places, *b_cols, *span)
    placed = F.lit(True)
    for p in places:
        if p not in null_safe:
            placed = placed & F.col(p).isNotNull()
    a_pieces, b_pieces = block_pieces(A.filter(placed), *span), block_pieces(B.filter(placed), *span)
    at = ["__block", *places]
    bits = a_pieces.select(*at, F.col("__mask").alias("__a"), F.lit(0).alias("__b")).unionByName(
        b_pieces.select(*at, F.lit(0).alias("__a"), F.col("__mask").alias("__b"))
    )
    bits = bits.groupBy(*at).agg(F.bit_or("__a").alias("__a"), F.bit_or("__b").alias("__b"))
    no_a, no_b = F.col("__b").bitwiseAND(F.bitwise_not("__a")), F.col("__a").bitwiseAND(F.bitwise_not("__b"))
    left = a_pieces.unionByName(bits.select(*at, no_a.alias("__mask"), *none(A, a_cols)).filter("__mask != 0"))
    right = b_pieces.unionByName(bits.select(*at, no_b.alias("__mask"), *none(B, b_cols)).filter("__mask != 0"))
    right = right.select(*[F.col(c).alias(f"__b_{c}") for c in [*at, "__mask"]], *b_cols)
    shared = F.col("__mask").bitwiseAND(F.col("__b___mask"))
    cond = (left["__block"] == right["__b___block"]) & (shared != 0)
    for p in places:
        cond = cond & (left[p].eqNullSafe(right[f"__b_{p}"]) if p in null_safe else (left[p] == right[f"__b_{p}"]))
    pairs = right.join(left, cond).select(*places, *a_cols, *b_cols, "__block", F.explode(mask_days(shared)).alias("__n"))
    names = [*keys, a_id, b_id, *a_carry, *b_carry]
    out = pairs.withColumn(day, F.date_from_unix_date(F.col("__block") * _BLOCK + F.col("__n"))).select(*names)
    for df, other, cols in ((A, B, b_cols), (B, A, a_cols)):
        alone = expand_days(df.filter(~placed), *span, day=day)
        out = out.unionByName(alone.select(*alone.columns, *none(other, cols)).select(*names))
    return out


def collapse_days(df: DataFrame, keys: list[str], day: str = "Day", skew_safe: bool = True) -> DataFrame:
    """Event-days back to spans (gaps and islands).

    Consecutive days share ``day - row_number``; each island becomes one span.
    Numbering uses the skew-safe scan, so one long-running event is not one task."""
    d = df.select(*keys, day).distinct()
    n = number_within(d, keys, [day], "__rn", skew_safe=skew_safe)
    g = n.withColumn("__island", F.unix_date(F.col(day)) - F.col("__rn"))
    return g.groupBy(*keys, "__island").agg(
        F.min(day).alias("begin_date"), F.max(day).alias("end_date"), F.count(F.lit(1)).cast("long").alias("n_days")
    ).drop("__island")


def merge_spans(df: DataFrame, keys: list[str], begin: str = "begin_date", end: str = "end_date", partitions: int | None = None) -> DataFrame:
    """A30 on spans: overlapping or adjacent spans of a key become one; equal, row for row, to
    ``collapse_days(expand_days(df), keys)`` without any day row.

    Spans that begin on one day are reduced to the longest before anything is shuffled.  In order of their
    begin, a span opens a new run when it begins later than the day after the largest end so far: a running maximum
    inside a written range, carried over range borders by one row a (key, range).  Reversed and open spans are left out."""
    per_day = df.filter(F.col(end) >= F.col(begin)).groupBy(*keys, F.col(begin).alias("__b")).agg(F.max(end).alias("__e"))
    t = ranged(per_day, keys, ["__b"], partitions)
    before = (Window.unboundedPreceding, -1)
    ends = t.groupBy(*keys, RANGE).agg(F.max("__e").alias("__m"))
    carried = ends.select(*keys, RANGE, F.max("__m").over(Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(*before)).alias("__carried"))
    seen = F.max("__e").over(Window.partitionBy(*keys, RANGE).orderBy(INDEX).rowsBetween(*before))
    t = join_null_safe(t.withColumn("__seen", seen), carried.filter(F.col("__carried").isNotNull()), [*keys, RANGE], "left")
    reached = F.greatest("__seen", "__carried")  # skips nulls
    t = t.withColumn("__opens", (reached.isNull() | (F.col("__b") > F.date_add(reached, 1))).cast("long"))
    upto = F.sum("__opens").over(Window.partitionBy(*keys, RANGE).orderBy(INDEX).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = join_null_safe(t.withColumn("__run", upto), range_offsets(t, keys, F.col("__opens")), [*keys, RANGE])
    merged = runs.groupBy(*keys, (F.col("__run") + F.col("__off")).alias("__run")).agg(F.min("__b").alias(begin), F.max("__e").alias(end))
    return merged.withColumn("n_days", (F.datediff(F.col(end), F.col(begin)) + 1).cast("long")).drop("__run")


def concurrency(df: DataFrame, keys: list[str], begin: str = "begin_date", end: str = "end_date", partitions: int | None = None) -> DataFrame:
    """How many spans of a key are open over time: maximal intervals of equal ``n_open`` (zero left out).

    A sweep line: a span is +1 on its first day and -1 on the day after its last; borders of one (key, day) are summed
    before the shuffle, and those that cancel out are dropped.  The running sum and the next border go over
    written ranges, so a busy place is not one task.  Reversed and open spans are left out."""
    spans = df.filter(F.col(end) >= F.col(begin))
    border = F.explode(F.array(F.struct(F.col(begin).alias("d"), F.lit(1).alias("n")), F.struct(F.date_add(F.col(end), 1).alias("d"), F.lit(-1).alias("n"))))
    borders = spans.select(*keys, border.alias("__x")).groupBy(*keys, F.col("__x.d").alias("__d")).agg(F.sum("__x.n").alias("__n")).filter("__n != 0")
    t = ranged(borders, keys, ["__d"], partitions)
    inside = Window.partitionBy(*keys, RANGE).orderBy(INDEX)
    firsts = t.groupBy(*keys, RANGE).agg(F.min("__d").alias("__first"))
    after = firsts.select(*keys, RANGE, F.lead("__first").over(Window.partitionBy(*keys).orderBy(RANGE)).alias("__after"))
    local = t.withColumn("__sum", F.sum("__n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("__next", F.lead("__d").over(inside))
    joined = join_null_safe(local, range_offsets(t, keys, F.col("__n")), [*keys, RANGE])
    joined = join_null_safe(joined, after, [*keys, RANGE])
    n_open = (F.col("__sum") + F.col("__off")).cast("long")
    until = F.date_sub(F.coalesce("__next", "__after"), 1)
    return joined.select(*keys, F.col("__d").alias(begin), until.alias(end), n_open.alias("n_open")).filter("n_open > 0")


def peaks(intervals: DataFrame, keys: list[str], begin: str = "begin_date", end: str = "end_date") -> DataFrame:
    """Per key of :func:`concurrency`: the largest number open at once, the first day of it, the days
    at that level, days with any span open, and span-days in all."""
    length = F.datediff(F.col(end), F.col(begin)) + 1
    level = intervals.withColumn("__len", length).groupBy(*keys, "n_open").agg(F.min(begin).alias("__b"), F.sum("__len").alias("__len"))
    top = F.max(F.struct("n_open", "__b", "__len")).alias("__top")  # one row a level, so n_open alone decides
    out = level.groupBy(*keys).agg(top, F.sum("__len").cast("long").alias("days_open"), F.sum(F.col("n_open") * F.col("__len")).cast("long").alias("span_days"))
    return out.select(
        *keys, F.col("__top.n_open").alias("peak_open"), F.col("__top.__b").alias("peak_begin"), F.col("__top.__len").cast("long").alias("peak_days"),
        "days_open", "span_days",
    )


def attach_latest(
    panel: DataFrame,
    events: DataFrame,
    keys: list[str],
    at: str,
    when: str,
    tie: str,
    columns: list[str] | None = None,
    forward: bool = False,
    within_days: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """As-of join (A31): every ``panel`` row with the latest event of its keys on or before the day ``at`` (``forward``: the
    earliest on or after).

    Events and panel rows are laid on one line by (keys, day) and the event is carried to the rows after it by the fill over
    written ranges, so a place with a third of all rows is many tasks, and no pair is ever formed.
    Of several events on one day the one with the largest ``tie`` counts.  Adds ``columns`` (default: ``when`` and ``tie``),
    NULL without an event, where a key or day is NULL, or, with ``within_days``, where the event is farther away."""
    columns = columns or [when, tie]
    clash = set(columns) & set(panel.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    usable = events.filter(F.col(when).isNotNull() & F.col(tie).isNotNull()).dropna(subset=keys)
    event = F.struct(F.col(when).alias("__when"), F.col(tie).alias("__tie"), *[F.col(c) for c in columns])
    per_day = usable.groupBy(*keys, F.col(when).alias("__day")).agg(F.max(F.struct(F.col(tie), event.alias("e")))["e"].alias("__event"))
    rows = panel.select(*keys, F.col(at).alias("__day"), F.struct(*[F.col(c) for c in panel.columns]).alias("__row"))
    line = per_day.withColumn("__row", F.lit(None).cast(rows.schema["__row"].dataType)).withColumn("__kind", F.lit(0 if not forward else 1))
    asked = rows.withColumn("__event", F.lit(None).cast(per_day.schema["__event"].dataType)).withColumn("__kind", F.lit(1 if not forward else 0))
    filled = fill_within(line.unionByName(asked), keys, ["__day", "__kind"], "__event", "up" if forward else "down", partitions=partitions)
    filled = filled.filter(F.col("__row").isNotNull())
    good = F.col("__event").isNotNull() & F.col("__day").isNotNull()
    if within_days is not None:
        good = good & (F.abs(F.datediff("__day", F.col("__event.__when"))) <= within_days)
    found = [F.when(good, F.col("__event")[c]).alias(c) for c in columns]
    return filled.select(*[F.col("__row")[c].alias(c) for c in panel.columns], *found)


def exposure(
    panel: DataFrame,
    events: DataFrame,
    panel_id: str,
    place_keys: list[str],
    event_id: str,
    bucket: str = "month",
) -> DataFrame:
    """Attach events to an outside panel by place and date range.

    ``panel``: panel_id, place keys, begin_date, end_date.  ``events``: event_id,
    place keys, begin_date, end_date.  Every panel row is kept; it gets the
    number of distinct overlapping events and the summed overlap days."""
    ev = events.select(
        F.col(event_id).alias("__eid"), *place_keys, F.col("begin_date").alias("__eb"), F.col("end_date").alias("__ee")
    )
    pairs = match_spans(panel.select(panel_id, *place_keys, "begin_date", "end_date"), ev, place_keys, bucket=bucket, b_begin="__eb", b_end="__ee")
    per = pairs.groupBy(panel_id).agg(
        F.count_distinct("__eid").cast("long").alias("n_events"), F.sum("overlap_days").cast("long").alias("exposure_days")
    )
    out = panel.join(per, on=panel_id, how="left")
    return out.withColumn("n_events", F.coalesce("n_events", F.lit(0).cast("long"))).withColumn(
        "exposure_days", F.coalesce("exposure_days", F.lit(0).cast("long"))
    )
