"""Analytical queries (A45-A55) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics as an
from ..operators.geo import expand_counties
from .base import YEARS, county_dim, decl_spans, impact_spans, register, star_casualties, star_dates, star_locations, star_types, with_ctes

SEARCH = dict(year=1997, state="DS", incident_type="1-URGENT")


@register(
    "event_search",
    with_ctes(
        ["star_types", "star_dates", "star_casualties", "star_locations"],
        f"""SELECT DISTINCT t.eventKey, t.incident_type, t.hazard_type, t.hazard_cluster,
       cast(d.eventStart AS VARCHAR) AS eventStart, cast(d.eventEnd AS VARCHAR) AS eventEnd,
       c.nKilled, c.nWounded, l.state, l.county, year(d.eventStart) AS Year
FROM star_types t
LEFT JOIN star_dates d ON t.eventKey = d.eventKey
LEFT JOIN star_casualties c ON t.eventKey = c.eventKey
LEFT JOIN star_locations l ON t.eventKey = l.eventKey
WHERE year(d.eventStart) = {SEARCH['year']} AND l.state = '{SEARCH['state']}' AND t.incident_type = '{SEARCH['incident_type']}'""",
    ),
    "A46",
)
def q_event_search(spark, sf):
    return an.search_events(
        star_types(spark, sf), star_dates(spark, sf), star_casualties(spark, sf), star_locations(spark, sf), **SEARCH
    )


@register(
    "units_affected_per_year",
    with_ctes(
        ["star_types", "star_dates", "star_locations"],
        """SELECT Year, count(*) AS Count FROM (
  SELECT DISTINCT l.state, l.county, year(d.eventStart) AS Year
  FROM star_locations l LEFT JOIN star_types t ON l.eventKey = t.eventKey
  LEFT JOIN star_dates d ON l.eventKey = d.eventKey
  WHERE t.hazard_cluster = 'URGENT') x GROUP BY Year""",
    ),
    "A47",
)
def q_units_affected(spark, sf):
    j = star_locations(spark, sf).join(star_types(spark, sf), "eventKey", "left").join(star_dates(spark, sf), "eventKey", "left")
    j = j.withColumn("Year", F.year("eventStart"))
    return an.units_affected(j, ["state", "county"], "Year", F.col("hazard_cluster") == "URGENT")


@register(
    "summarize",
    with_ctes(
        ["decl_spans"],
        """SELECT incident_type, cast(min(d) AS DOUBLE) AS min, round(quantile_cont(d, 0.25), 6) AS q1,
       round(quantile_cont(d, 0.5), 6) AS median, round(avg(d), 6) AS mean, round(quantile_cont(d, 0.75), 6) AS q3,
       cast(max(d) AS DOUBLE) AS max, count(*) AS n, count(*) - count(d) AS n_missing
FROM (SELECT incident_type, date_diff('day', begin_date, end_date) AS d FROM decl_spans) x
GROUP BY incident_type""",
    ),
    "A45",
)
def q_summarize(spark, sf):
    d = decl_spans(spark, sf).withColumn("d", F.datediff("end_date", "begin_date"))
    out = an.summarize(d, "d", ["incident_type"])
    return out.select(*[F.round(c, 6).alias(c) if c in ("q1", "median", "mean", "q3") else F.col(c) for c in out.columns])


def _impact_places(spark, sf):
    """Impact spans, county-less rows spread over the state's counties."""
    return expand_counties(impact_spans(spark, sf), county_dim(spark, sf))


IMPACT_DAYS_SQL = """impact_days AS (
  SELECT i.Source, i.eventid, i.rowkey, unnest(generate_series(i.begin_date, i.end_date, INTERVAL 1 DAY))::DATE AS Day,
         i.state, i.county, i.incident_type, i.nkill, i.nwound
  FROM (SELECT Source, eventid, rowkey, begin_date, end_date, state, county, incident_type, nkill, nwound
        FROM impact_spans WHERE county IS NOT NULL AND county <> ''
        UNION ALL
        SELECT x.Source, x.eventid, x.rowkey, x.begin_date, x.end_date, x.state, d.county, x.incident_type, x.nkill, x.nwound
        FROM impact_spans x JOIN county_dim d ON x.state = d.state
        WHERE x.county IS NULL OR x.county = '') i
  WHERE i.end_date >= i.begin_date)"""


@register(
    "mean_duration",
    with_ctes(
        ["impact_spans", "county_dim"],
        """SELECT state, round(avg(duration), 6) AS mean_duration FROM (
  SELECT state, date_diff('day', min(Day) OVER (PARTITION BY eventid), max(Day) OVER (PARTITION BY eventid)) + 1 AS duration
  FROM impact_days WHERE incident_type LIKE 'R:%') x GROUP BY state""",
        [IMPACT_DAYS_SQL],
    ),
    "A50",
)
def q_mean_duration(spark, sf):
    d = _impact_places(spark, sf).filter(F.col("incident_type").startswith("R:"))
    return an.mean_duration(d, "eventid", ["state"]).withColumn("mean_duration", F.round("mean_duration", 6))


def _pivot_sql(value_sql: str, source: str, year_col: str) -> str:
    cols = ",\n       ".join(
        f"round(avg(CASE WHEN {year_col} = {y} THEN {value_sql} END), 6) AS \"Year: {y}\"" for y in YEARS
    )
    listed = ", ".join(map(str, YEARS))
    other = f"round(avg(CASE WHEN {year_col} NOT IN ({listed}) THEN {value_sql} END), 6) AS \"Other years\""
    return f"SELECT state,\n       {cols},\n       {other}\nFROM {source} GROUP BY state"


@register(
    "duration_pivot",
    with_ctes(
        ["impact_spans", "county_dim"],
        _pivot_sql(
            "duration",
            """(SELECT state, year(Day) AS yr,
        date_diff('day', min(Day) OVER (PARTITION BY eventid), max(Day) OVER (PARTITION BY eventid)) + 1 AS duration
        FROM impact_days WHERE incident_type LIKE 'R:%') x""",
            "yr",
        ),
        [IMPACT_DAYS_SQL],
    ),
    "A51",
)
def q_duration_pivot(spark, sf):
    d = _impact_places(spark, sf).filter(F.col("incident_type").startswith("R:"))
    out = an.duration_pivot(d, "eventid", YEARS, row="state")
    return out.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) if c != "state" else F.col(c) for c in out.columns])


@register(
    "duration_pivot_events",
    with_ctes(
        ["impact_spans", "county_dim"],
        _pivot_sql(
            "duration",
            """(SELECT DISTINCT eventid, state, event_start, duration, year(event_start) AS yr FROM (
        SELECT eventid, state, min(Day) OVER (PARTITION BY eventid) AS event_start,
        date_diff('day', min(Day) OVER (PARTITION BY eventid), max(Day) OVER (PARTITION BY eventid)) + 1 AS duration
        FROM impact_days WHERE incident_type LIKE 'R:%') y) x""",
            "yr",
        ),
        [IMPACT_DAYS_SQL],
    ),
    "A51",
)
def q_duration_pivot_events(spark, sf):
    d = _impact_places(spark, sf).filter(F.col("incident_type").startswith("R:"))
    out = an.duration_pivot(d, "eventid", YEARS, row="state", event_weighted=True)
    return out.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) if c != "state" else F.col(c) for c in out.columns])


def _impact_pivot_sql(measure: str) -> str:
    cells = ",\n  ".join(f'round(sum(CASE WHEN yr = {y} THEN cell END), 6) AS "Year: {y}"' for y in YEARS)
    return with_ctes(
        ["impact_spans"],
        f"""SELECT incident_type, {cells},
  round(sum(CASE WHEN yr NOT IN ({", ".join(map(str, YEARS))}) THEN cell END), 6) AS "Other years", round(coalesce(sum(cell), 0.0), 6) AS total
FROM (SELECT incident_type, yr, CASE WHEN count(*) = count({measure}) THEN sum({measure}) END AS cell
      FROM (SELECT DISTINCT split_part(eventid, '-', 1) AS ev, incident_type, {measure},
                   unnest(generate_series(year(begin_date), year(end_date))) AS yr FROM impact_spans WHERE end_date >= begin_date) d
      GROUP BY incident_type, yr) w GROUP BY incident_type""",
    )


def _impact_pivot(spark, sf, measure):
    out = an.impact_pivot(impact_spans(spark, sf), F.substring_index("eventid", "-", 1), "incident_type", measure, YEARS)
    return out.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) if c != "incident_type" else F.col(c) for c in out.columns])


@register("impact_pivot_killed", _impact_pivot_sql("nkill"), "A52")
def q_impact_pivot_killed(spark, sf):
    return _impact_pivot(spark, sf, "nkill")


@register("impact_pivot_wounded", _impact_pivot_sql("nwound"), "A52")
def q_impact_pivot_wounded(spark, sf):
    return _impact_pivot(spark, sf, "nwound")


@register(
    "category_counts",
    with_ctes(
        ["decl_spans", "impact_spans"],
        """SELECT 'FEMA' AS Source, incident_type, count(*) AS n_events
FROM (SELECT DISTINCT array_to_string(string_split(eventid, '-')[1:2], '-') AS ev, incident_type FROM decl_spans) a GROUP BY incident_type
UNION ALL
SELECT 'EMDAT' AS Source, incident_type, count(*) AS n_events
FROM (SELECT DISTINCT split_part(eventid, '-', 1) AS ev, incident_type FROM impact_spans) b GROUP BY incident_type""",
    ),
    "A53",
)
def q_category_counts(spark, sf):
    sources = {"FEMA": (decl_spans(spark, sf), "-", 2), "EMDAT": (impact_spans(spark, sf), "-", 1)}
    return an.category_counts(sources, "eventid", "incident_type")


@register(
    "freq",
    with_ctes(["decl_spans"], "SELECT state, incident_type, count(*) AS n FROM decl_spans GROUP BY state, incident_type"),
    "A54",
)
def q_freq(spark, sf):
    return an.freq(decl_spans(spark, sf), ["state", "incident_type"])


DURATIONS_SQL = """durations AS (
  SELECT state, cast(date_diff('day', begin_date, end_date) AS DOUBLE) AS d, cast(year(begin_date) - 1990 AS DOUBLE) AS year
  FROM decl_spans WHERE end_date IS NOT NULL AND state IS NOT NULL)"""


def _durations(spark, sf):
    d = decl_spans(spark, sf).select(
        F.datediff("end_date", "begin_date").cast("double").alias("duration"),
        "state",
        (F.year("begin_date") - 1990).cast("double").alias("year"),
    )
    return d.filter(F.col("duration").isNotNull())


@register(
    "fit_duration",
    with_ctes(
        ["decl_spans"],
        """SELECT state, count(*) AS n, round(sum(d), 3) AS observed, round(sum(d), 3) AS fitted FROM durations GROUP BY state
UNION ALL SELECT '(year)', count(*), round(sum(year * d), 3), round(sum(year * d), 3) FROM durations""",
        [DURATIONS_SQL],
    ),
    "A55",
)
def q_fit_duration(spark, sf):
    """The score equations of a Poisson model: fitted totals equal the observed ones in every state, and weighted by year."""
    _, totals = an.fit_duration(_durations(spark, sf), moments=("year",))
    return totals.select("state", "n", F.round("observed", 3).alias("observed"), F.round("fitted", 3).alias("fitted"))


@register(
    "duration_coefficients",
    with_ctes(
        ["decl_spans"],
        """SELECT 'year' AS term, round(b, 6) AS estimate FROM beta WHERE i = 25
UNION ALL
SELECT c.state, round(ln(sum(s) / sum(n * exp(b * year))), 6) FROM cells c, beta WHERE i = 25 GROUP BY c.state""",
        [
            DURATIONS_SQL,
            "cells AS MATERIALIZED (SELECT state, year, cast(count(*) AS DOUBLE) AS n, sum(d) AS s FROM durations GROUP BY state, year)",
            """beta(i, b) AS (
  SELECT 0, cast(0 AS DOUBLE)
  UNION ALL
  SELECT i + 1, b + score / information FROM (
    SELECT i, b, sum(xs - s * m1 / m0) AS score, sum(s * (m2 / m0 - (m1 / m0) * (m1 / m0))) AS information FROM (
      SELECT i, b, state, sum(s) AS s, sum(year * s) AS xs, sum(n * exp(b * year)) AS m0,
             sum(n * year * exp(b * year)) AS m1, sum(n * year * year * exp(b * year)) AS m2
      FROM beta, cells WHERE i < 25 GROUP BY i, b, state) t GROUP BY i, b) u)""",
        ],
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "A55",
)
def q_duration_coefficients(spark, sf):
    """The model's year coefficient and the log rate of every state; the SQL solves the profile likelihood by Newton steps."""
    d = _durations(spark, sf)
    coefficients, _ = an.fit_duration(d)
    return an.level_estimates(coefficients, d, "state").withColumn("estimate", F.round("estimate", 6))
