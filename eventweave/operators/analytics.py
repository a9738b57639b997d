"""Analytical queries over the published tables and day tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import INDEX, RANGE, join_null_safe, range_offsets, ranged
from .spans import event_map, expand_days


def summarize(df: DataFrame, col: str, by: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Min, quartiles, median, mean, max (R ``summary``: linear quartiles).

    Exact quartiles come from counts per distinct value, running over written ranges of
    the sorted values, so no task holds a group's values; ``approx=True`` uses the
    sketch instead."""
    by, c = list(by or []), F.col(col)
    aggs = [
        F.min(c).cast("double").alias("min"),
        F.avg(c).alias("mean"),
        F.max(c).cast("double").alias("max"),
        F.count(F.lit(1)).cast("long").alias("n"),
        F.count(F.when(c.isNull(), 1)).cast("long").alias("n_missing"),
    ]
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    names = [*by, "min", "q1", "median", "mean", "q3", "max", "n", "n_missing"]
    if approx:
        sketch = [F.percentile_approx(c, p, 10000).cast("double").alias(q) for q, p in shares.items()]
        return df.groupBy(*by).agg(*aggs, *sketch).select(*names)
    stats = df.groupBy(*by).agg(*aggs)
    values = df.filter(c.isNotNull()).groupBy(*by, c.cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    rows = ranged(values, by, ["__v"])
    upto = F.sum("__n").over(Window.partitionBy(*by, RANGE).orderBy(INDEX).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = join_null_safe(rows.withColumn("__upto", upto), range_offsets(rows, by, F.col("__n")), [*by, RANGE])
    counted = counted.withColumn("__upto", F.col("__upto") + F.col("__off"))
    totals = rows.groupBy(*by).agg(F.sum("__n").alias("__total"))
    counted = join_null_safe(counted, totals, by) if by else counted.withColumn("__total", F.lit(totals.first()[0]))
    at = lambda p: (F.col("__total") - 1) * p  # noqa: E731 (position of the quantile, from 0)
    value = lambda k: F.min(F.when(F.col("__upto") > k, F.col("__v")))
    ends = [e for q, p in shares.items() for e in (value(F.floor(at(p))).alias(f"__lo_{q}"), value(F.ceil(at(p))).alias(f"__hi_{q}"))]
    found = counted.groupBy(*by).agg(*ends, F.first("__total").alias("__total"))
    between = [
        (F.col(f"__lo_{q}") + (F.col(f"__hi_{q}") - F.col(f"__lo_{q}")) * (at(p) - F.floor(at(p)))).alias(q) for q, p in shares.items()
    ]
    quartiles = found.select(*by, *between)
    joined = join_null_safe(stats, quartiles, by, "left") if by else stats.join(F.broadcast(quartiles), how="left")
    return joined.select(*names)


def search_events(
    types: DataFrame,
    dates: DataFrame,
    casualties: DataFrame,
    locations: DataFrame,
    year: int | None = None,
    state: str | None = None,
    incident_type: str | None = None,
    key: str = "eventKey",
) -> DataFrame:
    """A46 (flagship): types, left joined to dates, casualties and locations,
    filtered by start year / state / type, distinct.

    The filter is written after the joins, as a user writes it; Catalyst turns
    the left joins whose columns the filter rejects-on-NULL into inner joins and
    pushes each predicate to its table's scan."""
    j = types.join(dates, on=key, how="left").join(casualties, on=key, how="left").join(locations, on=key, how="left")
    j = j.withColumn("Year", F.year("eventStart"))
    cond = F.lit(True)
    if year is not None:
        # the same test as a date range as well, which parquet can push down
        lo, hi = F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year + 1}-01-01").cast("date")
        cond = cond & (F.col("Year") == year) & (F.col("eventStart") >= lo) & (F.col("eventStart") < hi)
    if state is not None:
        cond = cond & (F.col("state") == state)
    if incident_type is not None:
        cond = cond & (F.col("incident_type") == incident_type)
    return j.filter(cond).distinct()


def units_affected(df: DataFrame, units: list[str], year: str = "Year", predicate: Column | None = None) -> DataFrame:
    """Units (e.g. state, county) affected per year: distinct (units, year)
    then a count per year.  NULL units count as a unit (not countDistinct)."""
    t = df if predicate is None else df.filter(predicate)
    return t.select(*units, year).distinct().groupBy(year).agg(F.count(F.lit(1)).cast("long").alias("Count"))


def dossier(
    event_map: DataFrame,
    day_from: str,
    day_to: str,
    place: dict[str, str],
    a_rows: DataFrame,
    b_rows: DataFrame,
    a_id: str = "femaID",
    b_id: str = "emdatID",
) -> tuple[DataFrame, DataFrame]:
    """Events at one place in a date window: the distinct id pairs present
    in both sources, then the rows of each source for those ids."""
    cond = (F.col("Day") >= F.lit(day_from).cast("date")) & (F.col("Day") <= F.lit(day_to).cast("date"))
    for k, v in place.items():
        cond = cond & (F.col(k) == v)
    pairs = event_map.filter(cond).select(a_id, b_id).na.drop().distinct()
    return pairs.join(a_rows, on=a_id, how="left"), pairs.join(b_rows, on=b_id, how="left")


def reconcile(
    b_spans: DataFrame,
    a_spans: DataFrame,
    place: dict[str, str],
    type_pattern: str,
    a_id: str = "femaID",
    b_id: str = "emdatID",
    type_col: str = "incident_type",
    places: tuple[str, ...] = ("state", "county"),
    null_safe: tuple[str, ...] = ("county",),
) -> DataFrame:
    """For one place, the events of source b whose type matches a pattern,
    with their first/last day, linked through the event map to the records of
    source a at the same place.

    ``a_id`` names one span of ``a``, as the row ids of A09 do.  The links of a busy place outgrow its spans, so they are not shuffled: what
    is asked of either side travels on its day rows through the event map, and an id pair is kept on its first shared day alone.
    That is the first day of one of the two spans, and no span of the id that begins earlier at the place
    (``__reached``: the last day of those) reaches into the span of ``a``."""
    here = F.lit(True)
    for k, v in place.items():
        here = here & (F.col(k) == v)
    b = b_spans.filter(here & (F.col("end_date") >= F.col("begin_date")) & F.col(b_id).isNotNull())
    events = expand_days(b).filter(F.col(type_col).rlike(type_pattern)).groupBy(b_id, *place.keys(), type_col).agg(
        F.min("Day").alias("event_start"), F.max("Day").alias("event_end")
    )
    spans = b.groupBy(b_id, *places, "begin_date").agg(F.max("end_date").alias("end_date"))
    earlier = Window.partitionBy(b_id, *places).orderBy("begin_date").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("__reached", F.max("end_date").over(earlier)).withColumn("__begin", F.col("begin_date"))
    told = [type_col, "event_start", "event_end"]
    b_days = expand_days(spans.join(events.select(b_id, *told), b_id))
    a = a_spans.filter(here).withColumn("a_type", F.col(type_col)).withColumn("a_begin", F.col("begin_date")).withColumn("a_end", F.col("end_date"))
    a = a.select(a_id, *places, "begin_date", "end_date", "a_type", "a_begin", "a_end").distinct()
    links = event_map(expand_days(a), b_days, a_id, b_id, ("Day", *places), null_safe, ("a_type", "a_begin", "a_end"), ("__begin", "__reached", *told))
    first = (F.col("Day") == F.greatest("a_begin", "__begin")) & (F.col("__reached").isNull() | (F.col("__reached") < F.col("a_begin")))
    links = links.filter(F.col(a_id).isNotNull() & F.col(b_id).isNotNull() & first)
    return links.select(b_id, *place.keys(), *told, a_id, "a_type", "a_begin", "a_end")


def event_lengths(
    spans: DataFrame, id_col: str, by: list[str], begin: str = "begin_date", end: str = "end_date", by_year: bool = False
) -> DataFrame:
    """Per event and group: ``n`` day rows and the event's ``event_start``, ``event_end`` and
    ``duration`` (days, inclusive, over all its rows), from spans instead of exploded days.

    An event's groups travel as a short array on its one aggregated row (one entry for each
    group it has), so nothing is joined back.  ``by_year`` splits each span's days by calendar year."""
    b, e = F.col(begin), F.col(end)
    t = spans.filter(e >= b)
    if by_year:
        t = t.withColumn("__year", F.explode(F.sequence(F.year(b), F.year(e))))
        first = F.greatest(b, F.make_date("__year", F.lit(1), F.lit(1)))
        last = F.least(e, F.make_date("__year", F.lit(12), F.lit(31)))
    else:
        t, first, last = t.withColumn("__year", F.lit(None).cast("int")), b, e
    days = F.datediff(last, first) + 1
    t = t.groupBy(id_col, *by, "__year").agg(F.sum(days).alias("n"), F.min(first).alias("__b"), F.max(last).alias("__e"))
    group = F.struct(*[F.col(c) for c in by], F.col("__year"), F.col("n"))
    t = t.groupBy(id_col).agg(F.min("__b").alias("event_start"), F.max("__e").alias("event_end"), F.collect_list(group).alias("__g"))
    t = t.withColumn("duration", (F.datediff("event_end", "event_start") + 1).cast("int"))
    t = t.withColumn("__g", F.explode("__g"))
    return t.select(id_col, *[F.col(f"__g.{c}").alias(c) for c in by], F.col("__g.__year").alias("__year"), F.col("__g.n").alias("n"), "event_start", "event_end", "duration")


def _row_mean() -> Column:
    """Mean duration in which every day row of an event counts."""
    return F.sum(F.col("duration").cast("double") * F.col("n")) / F.sum("n")


def mean_duration(spans: DataFrame, id_col: str, by: list[str], begin: str = "begin_date", end: str = "end_date") -> DataFrame:
    """Mean event length per group, weighted by rows (each day row of an
    event counts, as in the reference), sorted longest first."""
    t = event_lengths(spans, id_col, by, begin, end)
    return t.groupBy(*by).agg(_row_mean().alias("mean_duration")).orderBy(F.desc("mean_duration"))


OTHER_YEARS = "Other years"


def year_labels(years: list[int]) -> list[str]:
    return [f"Year: {y}" for y in years]


def _year_label(year: Column, years: list[int]) -> Column:
    return F.when(year.isin(*years), F.concat(F.lit("Year: "), year.cast("string"))).otherwise(OTHER_YEARS)


def duration_pivot(
    spans: DataFrame,
    id_col: str,
    years: list[int],
    row: str = "state",
    begin: str = "begin_date",
    end: str = "end_date",
    event_weighted: bool = False,
) -> DataFrame:
    """Mean duration, ``row`` x ``Year: yyyy`` columns; years outside ``years``
    share the column ``Other years``.

    Row-weighted (default) averages over day rows, the year being each row's
    day; ``event_weighted`` has one row per (event, row) with the
    year of the event start.  Pivot values are given, so no extra job is run to
    discover them and the output schema is fixed."""
    t = event_lengths(spans, id_col, [row], begin, end, by_year=not event_weighted)
    year = F.year("event_start") if event_weighted else F.col("__year")
    mean = F.avg("duration") if event_weighted else _row_mean()
    return t.withColumn("__ylab", _year_label(year, years)).groupBy(row).pivot("__ylab", [*year_labels(years), OTHER_YEARS]).agg(mean)


def impact_pivot(
    spans: DataFrame,
    event: Column,
    type_col: str,
    measure: str,
    years: list[int],
    begin: str = "begin_date",
    end: str = "end_date",
) -> DataFrame:
    """Total impact per type and year, years as columns, plus a row total.

    Distinct (event, type, measure, year) first, so an event's total is counted
    once per year it touches; a (type, year) sum is NULL when any of its values
    is missing (``sum`` without ``na.rm``).  Years outside ``years`` share the column
    ``Other years``; the row total takes every year and skips NULL cells."""
    t = spans.filter(F.col(end) >= F.col(begin)).select(
        event.alias("__event"), type_col, measure, F.explode(F.sequence(F.year(begin), F.year(end))).alias("__year")
    ).distinct()
    strict_sum = F.when(F.count(measure) == F.count(F.lit(1)), F.sum(measure))
    cells = t.groupBy(type_col, "__year").agg(strict_sum.alias("__cell"))
    labels = [*year_labels(years), OTHER_YEARS]
    wide = cells.withColumn("__ylab", _year_label(F.col("__year"), years)).groupBy(type_col).pivot("__ylab", labels).agg(F.sum("__cell"))
    # every cell is under one of the labels, so their sum is the total of all years
    total = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0.0)) for c in labels), F.lit(0.0))
    return wide.withColumn("total", total).orderBy(F.desc("total"))


def category_counts(sources: dict[str, tuple[DataFrame, str, int]], id_col: str, type_col: str) -> DataFrame:
    """Per source, distinct (event, type) -> events per type; sources stacked.

    ``sources``: name -> (rows, delimiter, parts): the event id is the first ``parts`` parts
    of the row id, so ids of any width keep apart."""
    out = None
    for name, (df, delimiter, parts) in sources.items():
        t = df.select(F.substring_index(F.col(id_col), delimiter, parts).alias("__ev"), F.col(type_col).alias("incident_type")).distinct()
        c = t.groupBy("incident_type").agg(F.count(F.lit(1)).cast("long").alias("n_events")).withColumn("Source", F.lit(name))
        out = c if out is None else out.unionByName(c)
    return out.select("Source", "incident_type", "n_events")


def freq(df: DataFrame, cols: list[str], sort: bool = True) -> DataFrame:
    """Frequency table over one or more columns, most frequent first."""
    t = df.groupBy(*cols).agg(F.count(F.lit(1)).cast("long").alias("n"))
    return t.orderBy(F.desc("n"), *cols) if sort else t


def fit_duration(
    df: DataFrame, formula: str = "duration ~ state + year", max_iter: int = 25, by: str = "state", moments: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Poisson GLM of duration on state and year (distributed IRLS in
    Spark ML).  Returns one row per coefficient (term, estimate) and, per value of
    ``by``, the rows fitted with their observed and fitted totals (which agree for
    every level of a factor in the model, whatever the other terms).  ``moments``: numeric columns; each adds a row whose
    totals are weighted by it, under ``by`` = ``(column)`` (they agree only if the column's own coefficient is right)."""
    from pyspark.ml.feature import RFormula
    from pyspark.ml.regression import GeneralizedLinearRegression

    rf = RFormula(formula=formula, featuresCol="__features", labelCol="__label", handleInvalid="skip")
    fitted = rf.fit(df)
    data = fitted.transform(df).select(by, *moments, "__features", "__label")
    glm = GeneralizedLinearRegression(
        family="poisson", link="log", featuresCol="__features", labelCol="__label", maxIter=max_iter, tol=1e-10
    ).fit(data)
    attrs = data.schema["__features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    rows = [("(Intercept)", float(glm.intercept))] + [
        (names.get(i, f"x{i}"), float(v)) for i, v in enumerate(glm.coefficients.toArray())
    ]
    predicted = glm.transform(data)
    weighted = lambda w: [
        F.count(F.lit(1)).alias("n"), F.sum(w * F.col("__label")).alias("observed"), F.sum(w * F.col("prediction")).alias("fitted")
    ]
    totals = predicted.groupBy(by).agg(*weighted(F.lit(1.0)))
    for m in moments:
        totals = totals.unionByName(predicted.agg(*weighted(F.col(m))).withColumn(by, F.lit(f"({m})")))
    return df.sparkSession.createDataFrame(rows, "term STRING, estimate DOUBLE"), totals


def level_estimates(coefficients: DataFrame, levels: DataFrame, factor: str) -> DataFrame:
    """One row per level of ``factor`` with its own intercept (the model's intercept plus the level's coefficient,
    0 for the reference level), and one per numeric term, as (term, estimate): the same whichever level
    is the reference."""
    base = coefficients.filter("term = '(Intercept)'").select(F.col("estimate").alias("__base"))  # one row
    own = levels.select(F.col(factor).alias("term")).distinct().crossJoin(base)
    named = coefficients.withColumn("term", F.regexp_replace("term", f"^{factor}_", "")).withColumnRenamed("estimate", "__own")
    by_level = own.join(named, "term", "left").select("term", (F.col("__base") + F.coalesce("__own", F.lit(0.0))).alias("estimate"))
    numeric = coefficients.filter(~F.col("term").startswith(f"{factor}_") & (F.col("term") != "(Intercept)"))
    return by_level.unionByName(numeric)
