"""Span, day and matching plans (A09, A21-A31) on the driver tables.

The oracles explode both sides to day rows and join on the day (the way the
reference computes it); the Spark plans match spans first and expand only the
overlaps.  Equal results are the check that the rewrite is exact.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import spans as sp
from ..operators.cleaning import sequence_id
from ..operators.geo import expand_counties
from ..session import cut_lineage
from .base import CTE, CTE_DEPS, county_dim, decl_spans, impact_spans, register, stage, states, tbl, with_ctes

# ------------------------------------------------------------------ frames
def ship_spans(spark, sf):
    """Order -> shipment spans per line item; ``end_raw`` may precede the begin
    (about half do); ``end_date`` blanks reversed spans, one whole state and one
    (state, year) so both imputation levels and the no-data case occur."""
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = tbl(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = states(spark, sf)
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, o["o_custkey"] == c["c_custkey"])
    j = j.join(s, F.col("c_nationkey") == s["n_nationkey"])
    return j.select(
        F.expr("l_orderkey * 8 + l_linenumber").alias("rowkey"),
        F.col("abbr").alias("state"),
        F.year("o_orderdate").alias("yr"),
        F.col("o_orderpriority").alias("incident_type"),
        F.col("o_orderdate").cast("date").alias("begin_date"),
        F.expr("CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(l_shipdate as date) END").alias("end_raw"),
        F.expr(
            "CASE WHEN l_shipdate < o_orderdate THEN NULL WHEN n_nationkey = 6 THEN NULL "
            "WHEN n_nationkey = 2 AND year(o_orderdate) = 1997 THEN NULL ELSE cast(l_shipdate as date) END"
        ).alias("end_date"),
    )


CTE["ship_spans"] = """ship_spans AS (
  SELECT l_orderkey * 8 + l_linenumber AS rowkey, s.abbr AS state, year(o_orderdate) AS yr,
         o_orderpriority AS incident_type, cast(o_orderdate AS DATE) AS begin_date,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(l_shipdate AS DATE) END AS end_raw,
         CASE WHEN l_shipdate < o_orderdate THEN NULL WHEN s.n_nationkey = 6 THEN NULL
              WHEN s.n_nationkey = 2 AND year(o_orderdate) = 1997 THEN NULL ELSE cast(l_shipdate AS DATE) END AS end_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN states s ON c_nationkey = s.n_nationkey)"""
CTE_DEPS["ship_spans"] = ["states"]

CTE["impact_days"] = """impact_days AS (
  SELECT i.Source, i.eventid, i.rowkey, unnest(generate_series(i.begin_date, i.end_date, INTERVAL 1 DAY))::DATE AS Day,
         i.state, i.county, i.incident_type, i.nkill, i.nwound
  FROM (SELECT Source, eventid, rowkey, begin_date, end_date, state, county, incident_type, nkill, nwound
        FROM impact_spans WHERE county IS NOT NULL AND county <> ''
        UNION ALL
        SELECT x.Source, x.eventid, x.rowkey, x.begin_date, x.end_date, x.state, d.county, x.incident_type, x.nkill, x.nwound
        FROM impact_spans x JOIN county_dim d ON x.state = d.state
        WHERE x.county IS NULL OR x.county = '') i
  WHERE i.end_date >= i.begin_date)"""
CTE_DEPS["impact_days"] = ["impact_spans", "county_dim"]

CTE["fema"] = """fema AS (
  SELECT *, eventid || '_' || lpad(cast(rn AS VARCHAR), cast(greatest(3, length(cast(rn AS VARCHAR))) AS INTEGER), '0') AS femaID
  FROM (SELECT *, row_number() OVER (PARTITION BY eventid ORDER BY rowkey) AS rn FROM decl_spans) x)"""
CTE_DEPS["fema"] = ["decl_spans"]

CTE["fema_days"] = """fema_days AS (
  SELECT femaID, eventid, rowkey, unnest(generate_series(begin_date, end_date, INTERVAL 1 DAY))::DATE AS Day,
         state, county, incident_type, nkill, nwound
  FROM fema WHERE end_date IS NOT NULL AND end_date >= begin_date)"""
CTE_DEPS["fema_days"] = ["fema"]

CTE["event_map"] = """event_map AS (
  SELECT coalesce(a.Day, b.Day) AS Day, coalesce(a.state, b.state) AS state, coalesce(a.county, b.county) AS county,
         a.femaID, b.emdatID
  FROM (SELECT Day, state, county, femaID FROM fema_days) a
  FULL OUTER JOIN (SELECT Day, state, county, eventid AS emdatID FROM impact_days) b
  ON a.Day = b.Day AND a.state = b.state AND a.county IS NOT DISTINCT FROM b.county)"""
CTE_DEPS["event_map"] = ["fema_days", "impact_days"]


@stage
def fema_spans(spark, sf):
    """Declaration spans with their per-declaration row id (A09); a stage
    boundary (checkpointed) like the span files the reference saves."""
    return cut_lineage(sequence_id(decl_spans(spark, sf), "eventid", ["rowkey"], 3, out="femaID"), "fema_spans")


@stage
def fema_places(spark, sf):
    """:func:`fema_spans` with the columns alone that matching needs: the numbering shuffles and writes whole rows."""
    spans = decl_spans(spark, sf).select("eventid", "rowkey", "begin_date", "end_date", "state", "county")
    return cut_lineage(sequence_id(spans, "eventid", ["rowkey"], 3, out="femaID").drop("eventid", "rowkey"), "fema_places")


def fema_days(spark, sf):
    return sp.expand_days(fema_spans(spark, sf))


def impact_days(spark, sf):
    return sp.expand_days(impact_places(spark, sf))


def impact_places(spark, sf):
    """Impact spans, county-less rows spread over the state's counties."""
    return expand_counties(impact_spans(spark, sf), county_dim(spark, sf))


def event_map_rows(spark, sf, only=None):
    """The event map; ``only``: a condition on its keys, put on the days of both sides before they are matched."""
    if only is None:
        return sp.event_map(fema_places(spark, sf), impact_places(spark, sf).withColumnRenamed("eventid", "emdatID"), spans=("begin_date", "end_date"))
    a = fema_days(spark, sf).select("Day", "state", "county", "femaID")
    b = impact_days(spark, sf).select("Day", "state", "county", F.col("eventid").alias("emdatID"))
    return sp.event_map(a.filter(only), b.filter(only))


# ------------------------------------------------------------------ queries
@register(
    "sequence_id",
    with_ctes(["fema"], "SELECT eventid, rowkey, femaID FROM fema"),
    "A09",
)
def q_sequence_id(spark, sf):
    return sequence_id(decl_spans(spark, sf), "eventid", ["rowkey"], 3, out="femaID").select("eventid", "rowkey", "femaID")


@register(
    "audit_spans",
    with_ctes(
        ["ship_spans"],
        """SELECT incident_type, count(*) AS n_rows,
       count(CASE WHEN date_diff('day', begin_date, end_raw) < 0 THEN 1 END) AS n_reversed,
       count(CASE WHEN end_raw IS NULL THEN 1 END) AS n_missing_end
FROM ship_spans GROUP BY incident_type""",
    ),
    "A21",
)
def q_audit_spans(spark, sf):
    return sp.audit_spans(ship_spans(spark, sf), "incident_type", end="end_raw")


IMPUTE_SQL_CTES = [
    """l1 AS (SELECT *, cast(date_diff('day', begin_date, end_date) AS DOUBLE) AS duration FROM ship_spans)""",
    """l2 AS (SELECT *, coalesce(duration, avg(duration) OVER (PARTITION BY state, yr)) AS d2 FROM l1)""",
    """l3 AS (SELECT *, coalesce(d2, avg(d2) OVER (PARTITION BY state)) AS d3 FROM l2)""",
    """imputed AS (SELECT *, coalesce(end_date, begin_date + cast(round_even(d3, 0) AS INTEGER)) AS end_imputed FROM l3)""",
]


def _imputed(spark, sf):
    return sp.impute_end(ship_spans(spark, sf), [["state", "yr"], ["state"]])


@register(
    "impute_end",
    with_ctes(
        ["ship_spans"],
        """SELECT rowkey, state, yr, cast(begin_date AS VARCHAR) AS begin_date, cast(end_date AS VARCHAR) AS end_date,
       duration, cast(end_imputed AS VARCHAR) AS end_imputed FROM imputed""",
        IMPUTE_SQL_CTES,
    ),
    "A22",
)
def q_impute_end(spark, sf):
    return _imputed(spark, sf).select("rowkey", "state", "yr", "begin_date", "end_date", "duration", "end_imputed")


@register(
    "imputation_error",
    with_ctes(
        ["ship_spans"],
        """SELECT count(*) AS n_known, min(e) AS min_error, max(e) AS max_error,
       count(CASE WHEN e <> 0 THEN 1 END) AS n_nonzero
FROM (SELECT date_diff('day', end_imputed, end_date) AS e FROM imputed WHERE end_date IS NOT NULL) x""",
        IMPUTE_SQL_CTES,
    ),
    "A23",
)
def q_imputation_error(spark, sf):
    return sp.imputation_error(_imputed(spark, sf))


@register(
    "exclude_spans",
    with_ctes(
        ["decl_spans"],
        """SELECT eventid, rowkey, cast(begin_date AS VARCHAR) AS begin_date, cast(end_date AS VARCHAR) AS end_date,
       state, county, incident_type FROM decl_spans
WHERE incident_type <> '5-LOW' AND begin_date <= DATE '2000-06-30'""",
    ),
    "A24",
)
def q_exclude_spans(spark, sf):
    d = sp.exclude(decl_spans(spark, sf), ["5-LOW"], "2000-06-30")
    return d.select("eventid", "rowkey", "begin_date", "end_date", "state", "county", "incident_type")


@register(
    "expand_days",
    with_ctes(
        ["decl_spans"],
        """SELECT eventid, rowkey, unnest(generate_series(begin_date, end_date, INTERVAL 1 DAY))::DATE::VARCHAR AS Day,
       state, county FROM decl_spans WHERE end_date IS NOT NULL AND end_date >= begin_date""",
    ),
    "A25",
)
def q_expand_days(spark, sf):
    return sp.expand_days(decl_spans(spark, sf)).select("eventid", "rowkey", "Day", "state", "county")


DECL_DAYS_SQL = """decl_days AS (
  SELECT rowkey, state, county, unnest(generate_series(begin_date, end_date, INTERVAL 1 DAY))::DATE AS Day
  FROM decl_spans WHERE end_date IS NOT NULL AND end_date >= begin_date)"""
IMP_DAYS_SQL = """imp_days AS (
  SELECT rowkey, state, county, unnest(generate_series(begin_date, end_date, INTERVAL 1 DAY))::DATE AS Day
  FROM impact_spans WHERE end_date >= begin_date)"""


def _sides(spark, sf):
    a = decl_spans(spark, sf).select(F.col("rowkey").alias("a_rowkey"), "state", "county", "begin_date", "end_date")
    b = impact_spans(spark, sf).select(
        F.col("rowkey").alias("b_rowkey"),
        "state",
        "county",
        F.col("begin_date").alias("b_begin"),
        F.col("end_date").alias("b_end"),
    )
    return a, b


@register(
    "match_days_state",
    with_ctes(
        ["decl_spans", "impact_spans"],
        """SELECT cast(a.Day AS VARCHAR) AS Day, a.state, a.rowkey AS a_rowkey, b.rowkey AS b_rowkey
FROM decl_days a JOIN imp_days b ON a.Day = b.Day AND a.state = b.state""",
        [DECL_DAYS_SQL, IMP_DAYS_SQL],
    ),
    "A27",
)
def q_match_days_state(spark, sf):
    a, b = _sides(spark, sf)
    m = sp.match_days(a.drop("county"), b.drop("county"), ["state"], b_begin="b_begin", b_end="b_end", text=True)
    return m.select("Day", "state", "a_rowkey", "b_rowkey")


@register(
    "match_days_county",
    with_ctes(
        ["decl_spans", "impact_spans"],
        """SELECT cast(a.Day AS VARCHAR) AS Day, a.state, a.county, a.rowkey AS a_rowkey, b.rowkey AS b_rowkey
FROM decl_days a JOIN imp_days b ON a.Day = b.Day AND a.state = b.state AND a.county = b.county""",
        [DECL_DAYS_SQL, IMP_DAYS_SQL],
    ),
    "A27",
)
def q_match_days_county(spark, sf):
    a, b = _sides(spark, sf)
    m = sp.match_days(a, b, ["state", "county"], b_begin="b_begin", b_end="b_end", text=True)
    return m.select("Day", "state", "county", "a_rowkey", "b_rowkey")


@register(
    "match_spans",
    with_ctes(
        ["decl_spans", "impact_spans"],
        """SELECT a.rowkey AS a_rowkey, b.rowkey AS b_rowkey, a.state, a.county,
       cast(greatest(a.begin_date, b.begin_date) AS VARCHAR) AS overlap_begin,
       cast(least(a.end_date, b.end_date) AS VARCHAR) AS overlap_end,
       date_diff('day', greatest(a.begin_date, b.begin_date), least(a.end_date, b.end_date)) + 1 AS overlap_days
FROM decl_spans a JOIN impact_spans b
  ON a.state = b.state AND a.county = b.county AND a.begin_date <= b.end_date AND b.begin_date <= a.end_date
WHERE a.end_date >= a.begin_date AND b.end_date >= b.begin_date""",
    ),
    "A29",
)
def q_match_spans(spark, sf):
    a, b = _sides(spark, sf)
    m = sp.match_spans(a, b, ["state", "county"], bucket="day", b_begin="b_begin", b_end="b_end")
    return m.select("a_rowkey", "b_rowkey", "state", "county", "overlap_begin", "overlap_end", "overlap_days")


@register(
    "event_map",
    with_ctes(
        ["event_map"],
        "SELECT cast(Day AS VARCHAR) AS Day, state, county, femaID, emdatID FROM event_map",
    ),
    "A28",
)
def q_event_map(spark, sf):
    return event_map_rows(spark, sf)


@register(
    "collapse_days",
    """SELECT user_id, cast(min(d) AS VARCHAR) AS begin_date, cast(max(d) AS VARCHAR) AS end_date, count(*) AS n_days
FROM (SELECT user_id, d, d - cast(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS grp
      FROM (SELECT DISTINCT user_id, cast(ts AS DATE) AS d FROM events) x) y
GROUP BY user_id, grp""",
    "A30",
)
def q_collapse_days(spark, sf):
    ev = tbl(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("Day"))
    return sp.collapse_days(ev, ["user_id"])


@register(
    "exposure",
    with_ctes(
        ["decl_spans", "impact_spans"],
        """SELECT p.panel_id, p.state, p.county, cast(p.begin_date AS VARCHAR) AS begin_date,
       cast(p.end_date AS VARCHAR) AS end_date, coalesce(x.n_events, 0) AS n_events,
       coalesce(x.exposure_days, 0) AS exposure_days
FROM panel p LEFT JOIN (
  SELECT p.panel_id, count(DISTINCT e.eventid) AS n_events,
         cast(sum(date_diff('day', greatest(p.begin_date, e.begin_date), least(p.end_date, e.end_date)) + 1) AS BIGINT) AS exposure_days
  FROM panel p JOIN impact_spans e
    ON p.state = e.state AND p.county = e.county AND p.begin_date <= e.end_date AND e.begin_date <= p.end_date
  WHERE e.end_date >= e.begin_date
  GROUP BY p.panel_id) x ON p.panel_id = x.panel_id""",
        [
            """panel AS (SELECT DISTINCT state || '|' || county || '|' || cast(year(begin_date) AS VARCHAR) AS panel_id,
       state, county, make_date(year(begin_date), 1, 1) AS begin_date, make_date(year(begin_date), 12, 31) AS end_date
FROM decl_spans WHERE county IS NOT NULL)"""
        ],
    ),
    "A31",
)
def q_exposure(spark, sf):
    d = decl_spans(spark, sf).filter(F.col("county").isNotNull())
    y = F.year("begin_date")
    panel = d.select(
        F.concat_ws("|", "state", "county", y.cast("string")).alias("panel_id"),
        "state",
        "county",
        F.make_date(y, F.lit(1), F.lit(1)).alias("begin_date"),
        F.make_date(y, F.lit(12), F.lit(31)).alias("end_date"),
    ).distinct()
    ev = impact_spans(spark, sf).filter(F.col("county").isNotNull()).select("eventid", "state", "county", "begin_date", "end_date")
    return sp.exposure(panel, ev, "panel_id", ["state", "county"], "eventid")


@register(
    "expand_counties",
    with_ctes(
        ["impact_spans", "county_dim"],
        """SELECT eventid, state, county FROM impact_spans WHERE county IS NOT NULL AND county <> ''
UNION ALL
SELECT x.eventid, x.state, d.county FROM impact_spans x JOIN county_dim d ON x.state = d.state
WHERE x.county IS NULL OR x.county = ''""",
    ),
    "A26",
)
def q_expand_counties(spark, sf):
    return expand_counties(impact_spans(spark, sf), county_dim(spark, sf)).select("eventid", "state", "county")


CTE["open_days"] = """open_days AS (
  SELECT state, county, Day FROM fema_days UNION ALL SELECT state, county, Day FROM impact_days)"""
CTE_DEPS["open_days"] = ["fema_days", "impact_days"]
CTE["open_runs"] = """open_runs AS (
  SELECT state, county, n_open, min(Day) AS b, max(Day) AS e, count(*) AS n FROM (
    SELECT *, date_diff('day', DATE '1970-01-01', Day) - row_number() OVER (PARTITION BY state, county, n_open ORDER BY Day) AS g
    FROM (SELECT state, county, Day, count(*) AS n_open FROM open_days GROUP BY state, county, Day) c) x
  GROUP BY state, county, n_open, g)"""
CTE_DEPS["open_runs"] = ["open_days"]


def all_spans(spark, sf):
    """The spans of both sources with their places."""
    cols = ["state", "county", "begin_date", "end_date"]
    return fema_spans(spark, sf).select(*cols).unionByName(impact_places(spark, sf).select(*cols))


@register(
    "merge_spans",
    with_ctes(
        ["open_days"],
        """SELECT state, county, cast(min(Day) AS VARCHAR) AS begin_date, cast(max(Day) AS VARCHAR) AS end_date, count(*) AS n_days FROM (
  SELECT *, date_diff('day', DATE '1970-01-01', Day) - row_number() OVER (PARTITION BY state, county ORDER BY Day) AS g
  FROM (SELECT DISTINCT state, county, Day FROM open_days) d) x
GROUP BY state, county, g""",
    ),
    "A30",
)
def q_merge_spans(spark, sf):
    return sp.merge_spans(all_spans(spark, sf), ["state", "county"])


@register(
    "event_concurrency",
    with_ctes(["open_runs"], "SELECT state, county, cast(b AS VARCHAR) AS begin_date, cast(e AS VARCHAR) AS end_date, n_open FROM open_runs"),
    "A31,A47",
)
def q_event_concurrency(spark, sf):
    return sp.concurrency(all_spans(spark, sf), ["state", "county"])


@register(
    "concurrency_peaks",
    with_ctes(
        ["open_runs"],
        """SELECT state, county, max(n_open) AS peak_open, cast(min(CASE WHEN n_open = m THEN b END) AS VARCHAR) AS peak_begin,
       sum(CASE WHEN n_open = m THEN n ELSE 0 END) AS peak_days, sum(n) AS days_open, sum(n * n_open) AS span_days
FROM (SELECT *, max(n_open) OVER (PARTITION BY state, county) AS m FROM open_runs) x GROUP BY state, county""",
    ),
    "A31,A47",
)
def q_concurrency_peaks(spark, sf):
    places = ["state", "county"]
    return sp.peaks(sp.concurrency(all_spans(spark, sf), places), places)


@register(
    "latest_declaration",
    with_ctes(
        ["impact_spans", "decl_spans"],
        """SELECT i.rowkey, i.state, i.county, cast(i.begin_date AS VARCHAR) AS begin_date, cast(e.declared AS VARCHAR) AS declared, e.declaration, e.incident_type
FROM (SELECT rowkey, state, county, begin_date FROM impact_spans) i
ASOF LEFT JOIN (SELECT state, county, begin_date AS declared, max(rowkey) AS declaration, arg_max(incident_type, rowkey) AS incident_type
                FROM decl_spans GROUP BY state, county, begin_date) e
  ON i.state = e.state AND i.county = e.county AND i.begin_date >= e.declared""",
    ),
    "A31",
)
def q_latest_declaration(spark, sf):
    panel = impact_spans(spark, sf).select("rowkey", "state", "county", "begin_date")
    events = decl_spans(spark, sf).select("state", "county", F.col("begin_date").alias("declared"), F.col("rowkey").alias("declaration"), "incident_type")
    return sp.attach_latest(panel, events, ["state", "county"], "begin_date", "declared", "declaration", ["declared", "declaration", "incident_type"])
