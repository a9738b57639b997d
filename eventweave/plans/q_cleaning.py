"""Source normalizers and place hygiene (A01-A07) on raw feeds composed from
the driver tables (text dates, mixed state spellings, county suffixes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning as cl
from .base import decl_spans, register, states, tbl, with_ctes

# ------------------------------------------------------------- raw feeds
DECL_RAW_SQL = """decl_raw AS (
  SELECT 'DR-' || cast(o_orderkey AS VARCHAR) || '-' || s.abbr AS femaDeclarationString,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS incidentBeginDate,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL
              ELSE strftime(cast(o_orderdate AS DATE) + cast(o_orderkey % 5 AS INTEGER), '%Y-%m-%d') || 'T00:00:00Z' END AS incidentEndDate,
         s.abbr AS state, c_name || ' (County)' AS designatedArea, o_orderpriority AS incidentType
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN states s ON c_nationkey = s.n_nationkey)"""


def declarations_raw(spark, sf):
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = tbl(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    s = states(spark, sf)
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(s, F.col("c_nationkey") == s["n_nationkey"])
    return j.select(
        F.expr("'DR-' || cast(o_orderkey as string) || '-' || abbr").alias("femaDeclarationString"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("incidentBeginDate"),
        F.expr(
            "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE "
            "date_format(date_add(cast(o_orderdate as date), cast(o_orderkey % 5 as int)), 'yyyy-MM-dd') || 'T00:00:00Z' END"
        ).alias("incidentEndDate"),
        F.col("abbr").alias("state"),
        F.concat(F.col("c_name"), F.lit(" (County)")).alias("designatedArea"),
        F.col("o_orderpriority").alias("incidentType"),
    )


INC_RAW_SQL = """inc_raw AS (
  SELECT l_orderkey * 8 + l_linenumber AS eventid, year(l_shipdate) AS iyear, month(l_shipdate) AS imonth,
         CASE WHEN l_linenumber = 7 THEN 0 ELSE day(l_shipdate) END AS iday, s_nationkey % 5 AS country,
         CASE WHEN l_linenumber % 2 = 0 THEN s.state_name ELSE lower(s.abbr) END AS provstate,
         'city' || cast(l_partkey % 13 AS VARCHAR) AS city, l_returnflag AS attacktype1_txt,
         cast(l_quantity % 10 AS DOUBLE) AS nkill, round(l_tax * 100) AS nwound
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN states s ON s_nationkey = s.n_nationkey)"""


def incidents_raw(spark, sf):
    li = tbl(spark, sf, "lineitem")
    su = tbl(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    s = states(spark, sf)
    j = li.join(su, li["l_suppkey"] == su["s_suppkey"]).join(s, F.col("s_nationkey") == s["n_nationkey"])
    return j.select(
        F.expr("l_orderkey * 8 + l_linenumber").alias("eventid"),
        F.year("l_shipdate").alias("iyear"),
        F.month("l_shipdate").alias("imonth"),
        F.expr("CASE WHEN l_linenumber = 7 THEN 0 ELSE day(l_shipdate) END").alias("iday"),
        F.expr("s_nationkey % 5").alias("country"),
        F.expr("CASE WHEN l_linenumber % 2 = 0 THEN state_name ELSE lower(abbr) END").alias("provstate"),
        F.expr("'city' || cast(l_partkey % 13 as string)").alias("city"),
        F.col("l_returnflag").alias("attacktype1_txt"),
        F.expr("cast(l_quantity % 10 as double)").alias("nkill"),
        F.expr("round(l_tax * 100)").alias("nwound"),
    )


IMP_RAW_SQL = """imp_raw AS (
  SELECT 'DN' || cast(o_orderkey AS VARCHAR) AS "Dis No", CASE WHEN o_orderkey % 6 = 0 THEN 'CAN' ELSE 'USA' END AS ISO,
         year(o_orderdate) AS "Start Year", CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE month(o_orderdate) END AS "Start Month",
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE day(o_orderdate) END AS "Start Day",
         year(o_orderdate) AS "End Year", CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE month(o_orderdate) END AS "End Month",
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE day(o_orderdate) END AS "End Day",
         o_orderstatus AS "Disaster Type", CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS "Disaster Subtype",
         CAST(NULL AS VARCHAR) AS "Disaster Subsubtype", c_name || ' (Adm1).' AS Location,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE cast(o_orderkey % 50 AS DOUBLE) END AS "Total Deaths",
         CASE WHEN o_orderkey % 9 < 3 THEN NULL ELSE cast(o_orderkey % 20 AS DOUBLE) END AS "No Injured"
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def impacts_raw(spark, sf):
    o = tbl(spark, sf, "orders")
    c = tbl(spark, sf, "customer").select("c_custkey", "c_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.select(
        F.expr("'DN' || cast(o_orderkey as string)").alias("Dis No"),
        F.expr("CASE WHEN o_orderkey % 6 = 0 THEN 'CAN' ELSE 'USA' END").alias("ISO"),
        F.year("o_orderdate").alias("Start Year"),
        F.expr("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE month(o_orderdate) END").alias("Start Month"),
        F.expr("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE day(o_orderdate) END").alias("Start Day"),
        F.year("o_orderdate").alias("End Year"),
        F.expr("CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE month(o_orderdate) END").alias("End Month"),
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE day(o_orderdate) END").alias("End Day"),
        F.col("o_orderstatus").alias("Disaster Type"),
        F.expr("CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END").alias("Disaster Subtype"),
        F.lit(None).cast("string").alias("Disaster Subsubtype"),
        F.concat(F.col("c_name"), F.lit(" (Adm1).")).alias("Location"),
        F.expr("CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE cast(o_orderkey % 50 as double) END").alias("Total Deaths"),
        F.expr("CASE WHEN o_orderkey % 9 < 3 THEN NULL ELSE cast(o_orderkey % 20 as double) END").alias("No Injured"),
    )


def _states_dim(spark, sf):
    return states(spark, sf).select(F.col("state_name").alias("state"), "abbr")


def _compose_sql(y: str, m: str, d: str) -> str:
    pad = lambda c: f"lpad(cast({c} AS VARCHAR), cast(greatest(2, length(cast({c} AS VARCHAR))) AS INTEGER), '0')"
    return f"try_cast(concat_ws('-', cast({y} AS VARCHAR), {pad(m)}, {pad(d)}) AS DATE)"


# ------------------------------------------------------------------ queries
@register(
    "normalize_declarations",
    with_ctes(
        ["states"],
        """SELECT 'FEMA' AS Source, femaDeclarationString AS eventid,
       cast(try_cast(split_part(incidentBeginDate, 'T', 1) AS DATE) AS VARCHAR) AS begin_date,
       cast(try_cast(split_part(incidentEndDate, 'T', 1) AS DATE) AS VARCHAR) AS end_date,
       state, regexp_replace(designatedArea, ' \\(.*', '') AS county, incidentType AS incident_type
FROM decl_raw WHERE try_cast(split_part(incidentBeginDate, 'T', 1) AS DATE) >= DATE '1996-01-01'""",
        [DECL_RAW_SQL],
    ),
    "A01",
)
def q_normalize_declarations(spark, sf):
    return cl.normalize_declarations(declarations_raw(spark, sf), cutoff="1996-01-01")


NORM_INC_SQL = f"""norm_inc AS (
  SELECT 'GTD' AS Source, cast(i.eventid AS VARCHAR) AS eventid, {_compose_sql('iyear', 'imonth', 'iday')} AS begin_date,
         {_compose_sql('iyear', 'imonth', 'iday')} AS end_date, i.city, i.attacktype1_txt AS incident_type,
         i.nkill, i.nwound, coalesce(a.abbr, b.abbr) AS state
  FROM inc_raw i
  LEFT JOIN states a ON lower(i.provstate) = lower(a.state_name)
  LEFT JOIN states b ON upper(i.provstate) = upper(b.abbr)
  WHERE i.country = 1 AND i.nkill >= 3 AND {_compose_sql('iyear', 'imonth', 'iday')} >= DATE '1996-01-01')"""


def _norm_incidents(spark, sf):
    return cl.normalize_incidents(incidents_raw(spark, sf), _states_dim(spark, sf), country=1, min_killed=3, cutoff="1996-01-01")


@register(
    "normalize_incidents",
    with_ctes(
        ["states"],
        """SELECT Source, eventid, cast(begin_date AS VARCHAR) AS begin_date, cast(end_date AS VARCHAR) AS end_date,
       city, incident_type, nkill, nwound, state FROM norm_inc""",
        [INC_RAW_SQL, NORM_INC_SQL],
    ),
    "A02,A06",
)
def q_normalize_incidents(spark, sf):
    return _norm_incidents(spark, sf).select(
        "Source", "eventid", "begin_date", "end_date", "city", "incident_type", "nkill", "nwound", "state"
    )


@register(
    "normalize_impacts",
    with_ctes(
        [],
        f"""SELECT 'EMDAT' AS Source, "Dis No" AS eventid,
       cast({_compose_sql('"Start Year"', 'coalesce("Start Month", 1)', 'coalesce("Start Day", 1)')} AS VARCHAR) AS begin_date,
       cast({_compose_sql('"End Year"', 'coalesce("End Month", 12)', 'coalesce("End Day", 28)')} AS VARCHAR) AS end_date,
       regexp_replace(Location, ' \\(Adm\\d+\\)\\.?', '', 'g') AS Location,
       coalesce("Disaster Type", 'NA') || ':' || coalesce("Disaster Subtype", 'NA') || ':' || coalesce("Disaster Subsubtype", 'NA') AS incident_type,
       "Total Deaths" AS nkill, "No Injured" AS nwound
FROM imp_raw WHERE ISO = 'USA' AND ("Total Deaths" IS NOT NULL OR "No Injured" IS NOT NULL) AND "Dis No" NOT IN ('DN7')""",
        [IMP_RAW_SQL],
    ),
    "A05",
)
def q_normalize_impacts(spark, sf):
    return cl.normalize_impacts(impacts_raw(spark, sf), iso="USA", drop_ids=["DN7"])


@register(
    "union_sources",
    with_ctes(
        ["states"],
        """SELECT Source, eventid, cast(begin_date AS VARCHAR) AS begin_date, cast(end_date AS VARCHAR) AS end_date,
       state, county, incident_type, city, nkill, nwound FROM (
  SELECT Source, eventid, begin_date, end_date, state, county, incident_type,
         CAST(NULL AS VARCHAR) AS city, CAST(NULL AS DOUBLE) AS nkill, CAST(NULL AS DOUBLE) AS nwound
  FROM (SELECT 'FEMA' AS Source, femaDeclarationString AS eventid,
               try_cast(split_part(incidentBeginDate, 'T', 1) AS DATE) AS begin_date,
               try_cast(split_part(incidentEndDate, 'T', 1) AS DATE) AS end_date,
               state, regexp_replace(designatedArea, ' \\(.*', '') AS county, incidentType AS incident_type
        FROM decl_raw) d WHERE begin_date >= DATE '1996-01-01'
  UNION ALL
  SELECT Source, eventid, begin_date, end_date, state, CAST(NULL AS VARCHAR) AS county, incident_type, city, nkill, nwound
  FROM norm_inc) u""",
        [DECL_RAW_SQL, INC_RAW_SQL, NORM_INC_SQL],
    ),
    "A04",
)
def q_union_sources(spark, sf):
    d = cl.normalize_declarations(declarations_raw(spark, sf), cutoff="1996-01-01")
    u = cl.union_sources(d, _norm_incidents(spark, sf))
    return u.select("Source", "eventid", "begin_date", "end_date", "state", "county", "incident_type", "city", "nkill", "nwound")


@register(
    "canonical_state",
    with_ctes(
        ["states"],
        """SELECT c_custkey, raw, coalesce(a.abbr, b.abbr) AS state
FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN s.state_name WHEN 1 THEN lower(s.abbr) ELSE 'ZZ' END AS raw
      FROM customer JOIN states s ON c_nationkey = s.n_nationkey) r
LEFT JOIN states a ON lower(r.raw) = lower(a.state_name)
LEFT JOIN states b ON upper(r.raw) = upper(b.abbr)""",
    ),
    "A06",
)
def q_canonical_state(spark, sf):
    c = tbl(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = states(spark, sf)
    r = c.join(s, c["c_nationkey"] == s["n_nationkey"]).select(
        "c_custkey", F.expr("CASE c_custkey % 3 WHEN 0 THEN state_name WHEN 1 THEN lower(abbr) ELSE 'ZZ' END").alias("raw")
    )
    return cl.canonical_state(r, "raw", _states_dim(spark, sf)).select("c_custkey", "raw", "state")


@register(
    "clean_admin",
    with_ctes(
        ["decl_spans"],
        """SELECT eventid, rowkey, state, regexp_replace(lower(upper(county) || '.'), '\\.', '', 'g') AS county
FROM decl_spans WHERE state IN (SELECT abbr FROM states WHERE n_regionkey IN (0, 1, 2))""",
    ),
    "A07",
)
def q_clean_admin(spark, sf):
    d = decl_spans(spark, sf).withColumn("county", F.concat(F.upper("county"), F.lit(".")))
    allowed = states(spark, sf).filter(F.col("n_regionkey").isin(0, 1, 2)).select("abbr")
    return cl.clean_admin(d, allowed).select("eventid", "rowkey", "state", "county")


@register(
    "add_county",
    with_ctes(
        ["states"],
        """SELECT r.c_custkey, r.state, r.city, g.county
FROM (SELECT c_custkey, s.abbr AS state, 'city' || cast(c_custkey % 13 AS VARCHAR) AS city,
             CASE WHEN 'city' || cast(c_custkey % 13 AS VARCHAR) = 'city0' THEN 'city13'
                  ELSE 'city' || cast(c_custkey % 13 AS VARCHAR) END AS city_key
      FROM customer JOIN states s ON c_nationkey = s.n_nationkey) r
LEFT JOIN (SELECT s.abbr AS state_id, 'city' || cast(s_suppkey % 14 AS VARCHAR) AS city, min('c' || cast(s_suppkey % 7 AS VARCHAR)) AS county
           FROM supplier JOIN states s ON s_nationkey = s.n_nationkey GROUP BY 1, 2) g
  ON r.state = g.state_id AND r.city_key = g.city""",
    ),
    "A03",
)
def q_add_county(spark, sf):
    s = states(spark, sf)
    c = tbl(spark, sf, "customer").select("c_custkey", "c_nationkey")
    people = c.join(s, c["c_nationkey"] == s["n_nationkey"]).select(
        "c_custkey", F.col("abbr").alias("state"), F.expr("'city' || cast(c_custkey % 13 as string)").alias("city")
    )
    su = tbl(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    gaz = su.join(s, su["s_nationkey"] == s["n_nationkey"]).select(
        F.col("abbr").alias("state_id"),
        F.expr("'city' || cast(s_suppkey % 14 as string)").alias("city"),
        F.expr("'c' || cast(s_suppkey % 7 as string)").alias("county_name"),
    )
    return cl.add_county(people, gaz, aliases={"city0": "city13"}).select("c_custkey", "state", "city", "county")
