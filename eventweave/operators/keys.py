"""Shared event keys (A32-A37, A44): id pairs, keys per pair, and keys per class of linked ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import is_blank, pad_counter
from ..session import materialize
from .components import connected_components
from .ordered import fill_within, join_null_safe, number_flagged, number_within
from .spans import block_pieces, event_map, expand_days, mask_days, match_spans


def fill_updown(
    df: DataFrame, key: str, col: str, order: list[str | Column], skew_safe: bool = True, fill_null_key: bool = True
) -> DataFrame:
    """Within ``key``, a missing ``col`` takes the next non-missing value in
    ``order``, else the previous one.  An explicit order replaces R's row order.

    Rows without a key form a group too; ``fill_null_key=False`` passes them through instead
    (in the event map they are the rows of the other source alone, whose id is never missing)."""
    if fill_null_key:
        return fill_within(df, [key], order, col, "updown", skew_safe=skew_safe)
    filled = fill_within(df.filter(F.col(key).isNotNull()), [key], order, col, "updown", skew_safe=skew_safe)
    return filled.unionByName(df.filter(F.col(key).isNull()))


def filled_event_map(
    a: DataFrame, b: DataFrame, a_id: str = "femaID", b_id: str = "emdatID", places: tuple[str, ...] = ("state", "county"),
    null_safe: tuple[str, ...] = ("county",), day: str = "Day", span: tuple[str, str] = ("begin_date", "end_date"),
) -> DataFrame:
    """A28 + A32: the event map of two span tables with a missing ``b_id`` filled within ``a_id`` by (day, ``b_id``), as
    ``fill_updown(event_map(...), a_id, b_id, [day, b_id + " asc nulls last"], fill_null_key=False)`` does it on the day map.

    The map has a row for each pair and day, so it is neither written nor shuffled.  Only rows without a ``b_id`` (gaps, at most the
    days of ``a``, save for rows of ``b`` without an id) are numbered and filled.  A gap takes the smallest ``b_id`` of the next day that has one or the
    largest of the last, so beside the gaps the filling needs two ids a day of the spans that have gaps."""
    em = event_map(a, b, a_id, b_id, (day, *places), null_safe, spans=span)
    gaps = materialize(em.filter(F.col(a_id).isNotNull() & F.col(b_id).isNull()), "gaps")
    told = em.filter(F.col(a_id).isNull() | F.col(b_id).isNotNull())

    def at_place(left: DataFrame, right: DataFrame, at: str) -> DataFrame:
        r = right.select(*[F.col(c).alias(f"__r_{c}") for c in (at, *places)], *[c for c in right.columns if c not in (at, *places)])
        cond = left[at] == r[f"__r_{at}"]
        for p in places:
            cond = cond & (left[p].eqNullSafe(r[f"__r_{p}"]) if p in null_safe else (left[p] == r[f"__r_{p}"]))
        return left.join(r, cond).drop(*[f"__r_{c}" for c in (at, *places)])

    with_gaps = a.select(a_id, *places, *span).join(gaps.select(a_id).distinct(), a_id, "left_semi")
    # written, so that its size is known and the spans of ``b`` need no shuffle where it is small: a row a block and place at most
    asked = materialize(block_pieces(with_gaps, *span).groupBy("__block", *places).agg(F.bit_or("__mask").alias("__asked")), "asked_days")
    named = block_pieces(b.filter(F.col(b_id).isNotNull()).select(b_id, *places, *span), *span)
    days = F.explode(mask_days(F.col("__mask").bitwiseAND(F.col("__asked"))))
    near = at_place(named, asked, "__block").select(*places, b_id, "__block", days.alias("__n"))
    near = near.withColumn(day, F.date_from_unix_date(F.col("__block") * 8 + F.col("__n")))
    ends = near.groupBy(day, *places).agg(F.array_distinct(F.array(F.min(b_id), F.max(b_id))).alias("__ids"))
    known = at_place(expand_days(with_gaps, *span, day=day), ends, day).select(day, *places, a_id, F.explode("__ids").alias(b_id))
    rows = gaps.withColumn("__gap", F.lit(True)).unionByName(known.withColumn("__gap", F.lit(False)))
    filled = fill_updown(rows, a_id, b_id, [day, f"{b_id} asc nulls last"], fill_null_key=False)
    return told.unionByName(filled.filter("__gap").drop("__gap"))


def composite_id(df: DataFrame, a_id: str = "femaID", b_id: str = "emdatID", out: str = "smashedID") -> DataFrame:
    """Blanks for missing ids; cut the first-underscore suffix of ``a_id``
    (the pattern cuts from the first ``_`` after which no ``.`` follows) and
    join with ``b_id``: ``DR-1-TX_003`` + ``2005-0001`` -> ``DR-1-TX_2005-0001``."""
    t = df.na.fill({a_id: "", b_id: ""})
    return t.withColumn(out, F.concat(F.regexp_replace(F.col(a_id), r"_[^.]*$", ""), F.lit("_"), F.col(b_id)))


def mint_keys(
    event_map: DataFrame | tuple[DataFrame, DataFrame],
    id_col: str = "smashedID",
    day: str = "Day",
    state: str = "state",
    pad: int = 2,
    carry: tuple[str, ...] = ("femaID", "emdatID"),
    keep_state: bool = True,
    skew_safe: bool = True,
    existing: DataFrame | None = None,
    grouped: bool = False,
) -> DataFrame:
    """``yyyy_MM_ST_nn`` event keys.

    Per id: start = first day; one key row per (id, state) touched; number the
    ids within (start month, state) in id order; map back to the full ids.

    ``keep_state=True`` joins the map back on (id, state), so an id spanning two
    states pairs each place with its own state's key; ``False`` joins on the id
    alone (every place of the id gets every key, as a bare id join does).
    The (month, state) numbering goes through the skew-safe scan, with the full ids on its rows, so that nothing
    is joined back.  ``grouped``: ``event_map`` has one row for each (carry, id, state), as :func:`first_links` makes it.
    Two span tables instead of ``event_map`` stand for the map of their linked ids, ``composite_id(first_links(a, b))``, which has a row for
    each linked pair: its keys are numbered by counts and each is a row in the last join alone (:func:`.keyed.key_rows`).

    ``existing`` (id_col, state, eventKey) is the published key table: its (id, state) pairs keep
    their keys, and only new pairs are numbered, after the largest stored number of
    their (month, state).
    """
    if isinstance(event_map, tuple):
        if keep_state and existing is None:
            from .keyed import key_rows  # which builds on this module

            return key_rows(*event_map, *carry, out=id_col, places=(state, "county"), pad=pad)
        event_map = materialize(composite_id(first_links(*event_map, (state, "county"), ("county",), *carry, day), *carry, id_col), "linked_ids")
        grouped = True
    # one pass over the (large) event map: every distinct id row with its first day
    ids = event_map.select(*carry, id_col, state, F.col(day).alias("__d"))
    if not grouped:
        ids = ids.groupBy(*carry, id_col, state).agg(F.min("__d").alias("__d"))
    ids = _start_months(ids, [id_col], state, list(carry))
    stored = existing.select(id_col, state, "eventKey").distinct() if existing is not None else None
    if stored is not None:
        ids = materialize(join_null_safe(ids, stored, [id_col, state], "left"), "known_ids")
        known, ids = ids.filter(F.col("eventKey").isNotNull()), ids.filter(F.col("eventKey").isNull())
    k = _number_ids(ids, ["__ym", state], id_col, skew_safe)
    if stored is not None:
        number = F.substring_index("eventKey", "_", -1).cast("long")
        last = stored.groupBy(F.substring_index("eventKey", "_", 2).alias("__ym"), state).agg(F.max(number).alias("__last"))
        k = join_null_safe(k, last, ["__ym", state], "left").withColumn("__rn", F.col("__rn") + F.coalesce("__last", F.lit(0)))
    names = [*carry, id_col, state, "eventKey"]
    out = k.withColumn("eventKey", F.concat_ws("_", F.col("__ym"), F.col(state), pad_counter("__rn", pad))).select(*names)
    if stored is not None:
        out = out.unionByName(known.select(*names))
    if keep_state:
        return out
    per_id = out.select(id_col, "eventKey")
    if stored is not None:
        per_id = per_id.unionByName(stored.select(id_col, "eventKey"))
    out = out.select(*carry, id_col).distinct().join(per_id.distinct(), on=id_col, how="inner")
    return out.select(*carry, id_col, "eventKey").distinct()


def _start_months(ids: DataFrame, event: list[str], state: str, carry: list[str]) -> DataFrame:
    """Distinct id rows with ``__ym``, the month of their event's first day ``__d``, and ``__new``: 1 on one row of each
    (event, state), else 0.  One shuffle and one sort: rows of an event are dealt to one task, few as they are."""
    t = ids.dropna(subset=event).repartition(*[F.col(c) for c in event]).sortWithinPartitions(*event, state, *carry)
    start = F.min("__d").over(Window.partitionBy(*event))
    first = F.row_number().over(Window.partitionBy(*event, state).orderBy(*carry)) == 1
    return t.withColumn("__ym", F.date_format(start, "yyyy_MM")).withColumn("__new", first.cast("int")).drop("__d")


def _number_ids(ids: DataFrame, groups: list[str], id_col: str, skew_safe: bool) -> DataFrame:
    """``__rn``: the number of each row's id among the distinct ids of its group, in id order."""
    if not skew_safe:
        return ids.withColumn("__rn", F.dense_rank().over(Window.partitionBy(*groups).orderBy(id_col)).cast("long"))
    return number_flagged(ids, groups, [id_col, "__new desc"], "__new", "__rn")


def source_event_id(source: str = "Source", id_col: str = "eventid") -> Column:
    """A35 id rule per source: declarations lose their ``_suffix``; impacts lose
    the region counter after their last ``_`` or ``-``, of any width; incidents keep the row id."""
    s, i = F.col(source), F.col(id_col)
    return (
        F.when(s == "FEMA", F.regexp_replace(i, r"_[^.]*$", ""))
        .when(s == "EMDAT", F.regexp_replace(i, r"[_-][^_-]*$", ""))
        .otherwise(i)
    )


def mint_source_keys(
    spans: DataFrame,
    source: str = "Source",
    id_col: str = "eventid",
    day: str = "begin_date",
    state: str = "state",
    pad: int = 3,
    skew_safe: bool = True,
) -> DataFrame:
    """Older per-source keys (pad 3): each source numbers its own events within (month, state), so sources
    may use the same key; rows of all sources are then bound together.  Returns Source, eventid, super_id, state,
    eventKey."""
    t = spans.withColumn("__super", source_event_id(source, id_col))
    # one pass over the spans; the rest works on the distinct ids
    ids = t.groupBy(source, id_col, "__super", state).agg(F.min(day).alias("__d"))
    ids = _start_months(ids, [source, "__super"], state, [id_col]).dropna(subset=[state])
    k = _number_ids(ids, [source, "__ym", state], "__super", skew_safe)
    key = F.concat_ws("_", F.col("__ym"), F.col(state), pad_counter("__rn", pad)).alias("eventKey")
    return k.select(source, id_col, F.col("__super").alias("super_id"), state, key)


def check_disjoint(keys: DataFrame, a_id: str = "femaID", b_id: str = "emdatID", n_rows: str | None = None) -> DataFrame:
    """How many key rows carry the ids of both sources, of one alone, or of none (an id is missing when
    NULL or blank).  Sources that were keyed apart have no row with both; in a key table of matched
    events these are the matches.  ``n_rows``: the column with the number of key rows that a row stands for (:func:`.keyed.key_runs`)."""
    has_a, has_b = ~is_blank(a_id), ~is_blank(b_id)
    each = F.col(n_rows) if n_rows else F.lit(1)
    n = lambda c, name: F.coalesce(F.sum(F.when(c, each)), F.lit(0)).cast("long").alias(name)
    return keys.agg(
        n(has_a & has_b, "n_both"), n(has_a & ~has_b, "n_a_only"), n(~has_a & has_b, "n_b_only"), n(~has_a & ~has_b, "n_neither")
    )


def shared_keys(keys: DataFrame, source: str = "Source", key: str = "eventKey") -> DataFrame:
    """How many keys rows of several sources use, and how many keys there are."""
    per_key = keys.groupBy(key).agg((F.min(source) != F.max(source)).alias("__several"))
    return per_key.agg(F.count_if("__several").cast("long").alias("n_shared"), F.count(F.lit(1)).cast("long").alias("n_keys"))


def id_map(
    event_map: DataFrame,
    keys: DataFrame | Callable[[DataFrame], DataFrame],
    a_id: str = "femaID",
    b_id: str = "emdatID",
    key: str = "eventKey",
) -> DataFrame:
    """Every source id with its key: one full outer match per source id
    column, stacked, distinct.  Returns (source, id, eventKey).

    Instead of the key table ``keys`` may be a function that takes the distinct ids (source, id) and gives the match, as
    :func:`.keyed.keys_of_ids` does it without a row for each linked pair before the result."""
    distinct_ids = [event_map.select(F.col(n).alias("id")).filter(F.col("id").isNotNull() & (F.col("id") != "")).distinct() for n in (a_id, b_id)]
    if callable(keys):
        named = [ids.select(F.lit(n).alias("source"), "id") for n, ids in zip((a_id, b_id), distinct_ids)]
        return keys(named[0].unionByName(named[1])).select("source", "id", key)
    out = None
    for name, ids in zip((a_id, b_id), distinct_ids):
        kk = keys.select(F.col(name).alias("__kid"), key).filter(F.col("__kid") != "").distinct()
        j = ids.join(kk, ids["id"] == kk["__kid"], "full_outer").select(
            F.lit(name).alias("source"), F.coalesce("id", "__kid").alias("id"), key
        )
        out = j if out is None else out.unionByName(j)
    return out  # either half is distinct: distinct ids matched with distinct (id, key)


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once (empty when unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("n")).filter(F.col("n") > 1)


def link_ids(
    a: DataFrame, b: DataFrame, place_keys: list[str], null_safe: list[str] | None = None, a_id: str = "femaID", b_id: str = "emdatID",
    spanning: bool = False,
) -> DataFrame:
    """Distinct (a_id, b_id) of spans that share a place and a day: the id pairs of the filled event map (filling
    gives an id only to rows of an id it is paired with already), found without day rows.

    ``spanning``: instead of every pair, which are as many as a busy place has spans squared, at most one pair a span, with
    the same classes of directly or indirectly linked ids (see :func:`_spanning_links`)."""
    if spanning:
        return _spanning_links(a, b, place_keys, null_safe or [], a_id, b_id)
    left = a.select(F.col(a_id), *place_keys, F.col("begin_date").alias("__lb"), F.col("end_date").alias("__le"))
    pairs = match_spans(
        left, b.select(F.col(b_id), *place_keys, "begin_date", "end_date"), place_keys, null_safe_keys=null_safe, a_begin="__lb", a_end="__le"
    )
    return pairs.select(a_id, b_id).distinct()


def _spanning_links(a: DataFrame, b: DataFrame, places: list[str], null_safe: list[str], a_id: str, b_id: str) -> DataFrame:
    """Links with the classes of all overlapping pairs, at most one a span.

    A link day of a place is a day on which a span begins and both sources have an open span; every overlap begins on one, and
    all spans open on it are linked.  Link days that follow each other belong to one run if some span begun by the first
    lasts to the second, so spans are linked exactly if they touch the same run.  A span's run is that of the first
    link day from its begin on.  Each span is then paired with the smallest id of the other source in its run.
    The windows go over one row a place and day on which spans begin."""

    def side(df: DataFrame, id_col: str, n: int) -> DataFrame:
        t = df.filter(F.col("end_date") >= F.col("begin_date")).dropna(subset=[id_col, *(k for k in places if k not in null_safe)])
        return t.select(F.lit(n).alias("__side"), F.col(id_col).alias("__id"), *places, F.col("begin_date").alias("__b"), F.col("end_date").alias("__e"))

    spans = side(a, a_id, 0).unionByName(side(b, b_id, 1)).groupBy("__side", "__id", *places, "__b").agg(F.max("__e").alias("__e"))
    spans = materialize(spans, "link_spans")
    last = [F.max(F.when(F.col("__side") == n, F.col("__e"))).alias(f"__e{n}") for n in (0, 1)]
    days = spans.groupBy(*places, "__b").agg(*last)
    line = Window.partitionBy(*places).orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*places).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*places).orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for n in (0, 1):
        days = days.withColumn(f"__e{n}", F.max(f"__e{n}").over(line))
    reach = F.when((F.col("__e0") >= F.col("__b")) & (F.col("__e1") >= F.col("__b")), F.greatest("__e0", "__e1"))
    days = days.withColumn("__reach", reach)  # null on days that link nothing
    reached = F.max("__reach").over(earlier)
    opens = F.when(F.col("__reach").isNotNull() & (reached.isNull() | (reached < F.col("__b"))), F.col("__b"))
    days = days.withColumn("__opens", opens).withColumn("__run", F.last("__opens", ignorenulls=True).over(line))
    following = F.when(F.col("__reach").isNotNull(), F.struct(F.col("__b").alias("day"), F.col("__run").alias("run")))
    days = days.select(*places, "__b", F.last(following, ignorenulls=True).over(ahead).alias("__next"))
    placed = join_null_safe(spans, days, [*places, "__b"]).filter(F.col("__next.day") <= F.col("__e"))
    placed = placed.select("__side", "__id", *places, F.col("__next.run").alias("__run"))
    least = placed.groupBy(*places, "__run").agg(*[F.min(F.when(F.col("__side") == n, F.col("__id"))).alias(f"__id{n}") for n in (0, 1)])
    linked = join_null_safe(placed, least, [*places, "__run"])
    own = lambda n: F.when(F.col("__side") == n, F.col("__id")).otherwise(F.col(f"__id{n}"))
    return linked.select(own(0).alias(a_id), own(1).alias(b_id)).distinct()


def first_links(
    a: DataFrame, b: DataFrame, places: tuple[str, ...] = ("state", "county"), null_safe: tuple[str, ...] = ("county",),
    a_id: str = "femaID", b_id: str = "emdatID", day: str = "Day",
) -> DataFrame:
    """A28 + A32 on spans: the distinct ids of the filled event map with the first day of each, (a_id, b_id, places[0], day);
    equal to grouping the filled day map, without a day row.

    ``a_id`` names one span of ``a``, as the row ids of A09 do.  A pair's first day is the first of its overlap.  Filling adds days: those before a
    matched day, back to the previous matched day or the span's begin, go to the smallest ``b_id`` that starts there.  A span
    of ``a`` without a match has a row of its own, and so has a span of ``b`` with a day that nothing covers.
    What is already covered is a running maximum over the overlaps of one span, reduced to one row a day before."""
    place = places[0]
    left = a.filter(F.col("end_date") >= F.col("begin_date")).select(
        a_id, *places, F.col("begin_date").alias("__lb"), F.col("end_date").alias("__le")
    )
    right = b.filter(F.col("end_date") >= F.col("begin_date")).select(b_id, *places, "begin_date", "end_date")
    pairs = match_spans(left, right, list(places), "week", null_safe_keys=list(null_safe), a_begin="__lb", a_end="__le")
    pairs = materialize(pairs.drop("__le", "overlap_days"), "links")
    none = F.lit(None).cast("string")
    own = pairs.select(a_id, b_id, place, F.col("overlap_begin").alias(day))

    def reached(keys: list[str], begin: str) -> Column:
        before = Window.partitionBy(*keys).orderBy("overlap_begin").rowsBetween(Window.unboundedPreceding, -1)
        return F.greatest(F.max("__until").over(before), F.date_sub(F.col(begin), 1))  # skips the null of the first row

    starts = pairs.groupBy(a_id, place, "__lb", "overlap_begin").agg(F.min(b_id).alias(b_id), F.max("overlap_end").alias("__until"))
    starts = starts.withColumn("__reached", reached([a_id], "__lb")).filter(F.col("overlap_begin") > F.date_add("__reached", 1))
    filled = starts.select(a_id, b_id, place, F.date_add("__reached", 1).alias(day))
    alone = left.join(pairs.select(a_id).distinct(), a_id, "left_anti").select(a_id, none.alias(b_id), place, F.col("__lb").alias(day))
    span = [b_id, *places, "begin_date", "end_date"]
    covers = pairs.groupBy(*span, "overlap_begin").agg(F.max("overlap_end").alias("__until"))
    covers = covers.withColumn("__reached", reached(span, "begin_date"))
    hole = F.when(F.col("overlap_begin") > F.date_add("__reached", 1), F.date_add("__reached", 1))
    covers = covers.groupBy(*span).agg(F.min(hole).alias("__hole"), F.max("__until").alias("__until"))
    after = F.when(F.col("__until") < F.col("end_date"), F.date_add("__until", 1))
    uncovered = join_null_safe(right.distinct(), covers, span, "left")
    uncovered = uncovered.withColumn(day, F.when(F.col("__until").isNull(), F.col("begin_date")).otherwise(F.least("__hole", after)))
    rest = uncovered.filter(F.col(day).isNotNull()).select(none.alias(a_id), b_id, place, day)
    return own.unionByName(filled).unionByName(alone).unionByName(rest).groupBy(a_id, b_id, place).agg(F.min(day).alias(day))


def event_classes(
    pairs: DataFrame, first_days: DataFrame, a_id: str = "femaID", b_id: str = "emdatID", key: str = "eventKey", pad: int = 4
) -> DataFrame:
    """One key per real event (A33-A37): ids linked by ``pairs``, directly or through others, are one event.

    ``first_days`` (source, id, day) lists the ids of both sources, ``source`` being ``a_id`` or ``b_id``; an id without
    a link is an event of its own.  An event's key is ``yyyy_MM_nnnn``: the month of its first day, and its number among
    the month's events in order of their smallest ``source:id``.  Returns source, id, root, eventStart, key.
    Links whose id is null are ignored, and so are ids without a day; an id that only ``pairs`` names joins events
    but gets no row."""
    name = lambda source, c: F.concat(F.lit(source + ":"), F.col(c))
    roots = connected_components(pairs.select(name(a_id, a_id).alias("a"), name(b_id, b_id).alias("b")))
    days = first_days.filter("id IS NOT NULL AND day IS NOT NULL").groupBy("source", "id").agg(F.min("day").alias("__d"))
    days = days.withColumn("node", F.concat_ws(":", "source", "id"))
    ids = days.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).drop("node")
    ids = materialize(ids, "event_classes")
    events = ids.groupBy("root").agg(F.min("__d").alias("eventStart"))
    events = number_within(events.withColumn("__ym", F.date_format("eventStart", "yyyy_MM")), ["__ym"], ["root"], "__rn")
    events = events.withColumn(key, F.concat_ws("_", "__ym", pad_counter("__rn", pad)))
    return ids.drop("__d").join(events.select("root", "eventStart", key), "root").select("source", "id", "root", "eventStart", key)
