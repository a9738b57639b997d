"""Driver tables mapped onto the engine's inputs, once in Spark and once in SQL.

Every query plan reads the driver tables (or frames derived from them here),
so its work grows with the scale factor.  Each Spark base frame has a SQL CTE
twin with identical semantics; the oracles are built from those CTEs.

Mapping (SURVEY section 5):
* ``states``       nation -> (state_name, abbr): a two-letter code from the
                   region letter and the nation letter.
* ``decl_spans``   orders as declaration spans (4 orders per declaration id),
                   place = customer's state + county ``c<custkey % 7>``.
* ``impact_spans`` line items as impact spans (id ``EM<order>-<line 4 digits>``),
                   place = supplier's state + county ``c<partkey % 7>``.
* ``star_*``       a ready star schema (types, dates, casualties, locations)
                   keyed by order, for the user-level search queries.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.readers import read_table

# Letters used for the two-letter state codes.
ALPHA = "ABCDEFGHIJKLMNOPQRSTUVWXY"
ABBR_EXPR = f"substr('{ALPHA}', n_regionkey + 1, 1) || substr('{ALPHA}', n_nationkey + 1, 1)"
YEARS = list(range(1995, 2002))


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}
_BUILD = threading.local()


def register(name: str, sql: str | None, operators: str):
    def deco(fn):
        def build(spark: SparkSession, sf: str) -> DataFrame:
            _BUILD.stages = {}
            try:
                return present(fn(spark, sf))
            finally:
                _BUILD.stages = None

        REGISTRY[name] = Query(name, build, sql, operators)
        return fn

    return deco


def stage(fn):
    """A pipeline stage (a written table): built once per query build, however
    many branches of that query read it."""

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf: str) -> DataFrame:
        memo = getattr(_BUILD, "stages", None)
        if memo is None:
            return fn(spark, sf)
        key = (fn.__name__, sf)
        if key not in memo:
            memo[key] = fn(spark, sf)
        return memo[key]

    return wrapper


def present(df: DataFrame) -> DataFrame:
    """Driver-facing types: dates as ``yyyy-MM-dd`` text, timestamps as text,
    all integers as BIGINT, floats as DOUBLE (the SQL oracles cast alike)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def tbl(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


# ---------------------------------------------------------------- base frames
def states(spark: SparkSession, sf: str) -> DataFrame:
    return tbl(spark, sf, "nation").select(
        "n_nationkey", "n_regionkey", F.col("n_name").alias("state_name"), F.expr(ABBR_EXPR).alias("abbr")
    )


def decl_spans(spark: SparkSession, sf: str) -> DataFrame:
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = tbl(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = states(spark, sf)
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(s, F.col("c_nationkey") == s["n_nationkey"])
    return j.select(
        F.lit("FEMA").alias("Source"),
        F.expr("'DR-' || cast(o_orderkey div 4 as string)").alias("eventid"),
        F.col("o_orderkey").alias("rowkey"),
        F.col("o_orderdate").cast("date").alias("begin_date"),
        F.expr(
            "CASE WHEN o_orderkey % 13 = 0 THEN NULL "
            "ELSE date_add(cast(o_orderdate as date), cast(o_orderkey % 5 as int)) END"
        ).alias("end_date"),
        F.col("abbr").alias("state"),
        F.expr("CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'c' || cast(o_custkey % 7 as string) END").alias("county"),
        F.col("o_orderpriority").alias("incident_type"),
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN cast(o_orderkey % 4 as double) END").alias("nkill"),
        F.expr("CASE WHEN o_orderkey % 5 = 0 THEN cast(o_custkey % 6 as double) END").alias("nwound"),
    )


def impact_spans(spark: SparkSession, sf: str) -> DataFrame:
    li = tbl(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"
    )
    su = tbl(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    s = states(spark, sf)
    j = li.join(su, li["l_suppkey"] == su["s_suppkey"]).join(s, F.col("s_nationkey") == s["n_nationkey"])
    return j.select(
        F.lit("EMDAT").alias("Source"),
        F.expr("'EM' || cast(l_orderkey as string) || '-' || lpad(cast(l_linenumber as string), 4, '0')").alias("eventid"),
        F.expr("l_orderkey * 8 + l_linenumber").alias("rowkey"),
        F.col("l_shipdate").cast("date").alias("begin_date"),
        F.expr("date_add(cast(l_shipdate as date), l_linenumber % 4)").alias("end_date"),
        F.col("abbr").alias("state"),
        F.expr("CASE WHEN l_linenumber = 3 THEN NULL ELSE 'c' || cast(l_partkey % 7 as string) END").alias("county"),
        F.expr("l_returnflag || ':' || l_linestatus").alias("incident_type"),
        F.col("l_quantity").alias("nkill"),
        F.expr("CASE WHEN l_discount = 0 THEN NULL ELSE round(l_discount * 100) END").alias("nwound"),
    )


def county_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Counties per state as the declarations name them (a data-derived gazetteer)."""
    return decl_spans(spark, sf).filter(F.col("county").isNotNull()).select("state", "county").distinct()


def star_types(spark, sf):
    return tbl(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("eventKey"),
        F.col("o_orderpriority").alias("incident_type"),
        F.col("o_orderstatus").alias("hazard_type"),
        F.expr("substr(o_orderpriority, 3)").alias("hazard_cluster"),
    )


def star_dates(spark, sf):
    return tbl(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("eventKey"),
        F.col("o_orderdate").cast("date").alias("eventStart"),
        F.expr("date_add(cast(o_orderdate as date), cast(o_orderkey % 5 as int))").alias("eventEnd"),
    )


def star_casualties(spark, sf):
    """Casualties of an order: the totals of all its lines."""
    rows = tbl(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("nKilled"), F.sum(F.expr("round(l_tax * 100)")).alias("nWounded")
    )
    return rows.select(F.col("l_orderkey").cast("string").alias("eventKey"), "nKilled", "nWounded")


def star_locations(spark, sf):
    """Places of an order: its customer's state (county = market segment) and
    every supplier state of its lines (county from the part)."""
    s = states(spark, sf)
    o = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey")
    cu = tbl(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    home = o.join(cu, o["o_custkey"] == cu["c_custkey"]).join(s, F.col("c_nationkey") == s["n_nationkey"]).select(
        F.col("o_orderkey").cast("string").alias("eventKey"),
        F.col("abbr").alias("state"),
        F.lower("c_mktsegment").alias("county"),
    )
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    su = tbl(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(su, li["l_suppkey"] == su["s_suppkey"]).join(s, F.col("s_nationkey") == s["n_nationkey"])
    shipped = j.select(
        F.col("l_orderkey").cast("string").alias("eventKey"),
        F.col("abbr").alias("state"),
        F.expr("'c' || cast(l_partkey % 7 as string)").alias("county"),
    )
    return home.unionByName(shipped).distinct()


# ------------------------------------------------------------ SQL CTE twins
CTE = {
    "states": f"states AS (SELECT n_nationkey, n_regionkey, n_name AS state_name, {ABBR_EXPR} AS abbr FROM nation)",
    "decl_spans": """decl_spans AS (
  SELECT 'FEMA' AS Source, 'DR-' || cast(o_orderkey // 4 AS VARCHAR) AS eventid, o_orderkey AS rowkey,
         cast(o_orderdate AS DATE) AS begin_date,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL
              ELSE cast(o_orderdate AS DATE) + cast(o_orderkey % 5 AS INTEGER) END AS end_date,
         s.abbr AS state,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'c' || cast(o_custkey % 7 AS VARCHAR) END AS county,
         o_orderpriority AS incident_type,
         CASE WHEN o_orderkey % 3 = 0 THEN cast(o_orderkey % 4 AS DOUBLE) END AS nkill,
         CASE WHEN o_orderkey % 5 = 0 THEN cast(o_custkey % 6 AS DOUBLE) END AS nwound
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN states s ON c_nationkey = s.n_nationkey)""",
    "impact_spans": """impact_spans AS (
  SELECT 'EMDAT' AS Source,
         'EM' || cast(l_orderkey AS VARCHAR) || '-' || lpad(cast(l_linenumber AS VARCHAR), 4, '0') AS eventid,
         l_orderkey * 8 + l_linenumber AS rowkey,
         cast(l_shipdate AS DATE) AS begin_date,
         cast(l_shipdate AS DATE) + cast(l_linenumber % 4 AS INTEGER) AS end_date,
         s.abbr AS state,
         CASE WHEN l_linenumber = 3 THEN NULL ELSE 'c' || cast(l_partkey % 7 AS VARCHAR) END AS county,
         l_returnflag || ':' || l_linestatus AS incident_type,
         l_quantity AS nkill,
         CASE WHEN l_discount = 0 THEN NULL ELSE round(l_discount * 100) END AS nwound
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN states s ON s_nationkey = s.n_nationkey)""",
    "county_dim": "county_dim AS (SELECT DISTINCT state, county FROM decl_spans WHERE county IS NOT NULL)",
    "star_types": """star_types AS (
  SELECT cast(o_orderkey AS VARCHAR) AS eventKey, o_orderpriority AS incident_type,
         o_orderstatus AS hazard_type, substr(o_orderpriority, 3) AS hazard_cluster FROM orders)""",
    "star_dates": """star_dates AS (
  SELECT cast(o_orderkey AS VARCHAR) AS eventKey, cast(o_orderdate AS DATE) AS eventStart,
         cast(o_orderdate AS DATE) + cast(o_orderkey % 5 AS INTEGER) AS eventEnd FROM orders)""",
    "star_casualties": """star_casualties AS (
  SELECT cast(l_orderkey AS VARCHAR) AS eventKey, sum(l_quantity) AS nKilled, sum(round(l_tax * 100)) AS nWounded
  FROM lineitem GROUP BY l_orderkey)""",
    "star_locations": """star_locations AS (
  SELECT cast(o_orderkey AS VARCHAR) AS eventKey, s.abbr AS state, lower(c_mktsegment) AS county
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN states s ON c_nationkey = s.n_nationkey
  UNION
  SELECT cast(l_orderkey AS VARCHAR) AS eventKey, s.abbr AS state, 'c' || cast(l_partkey % 7 AS VARCHAR) AS county
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN states s ON s_nationkey = s.n_nationkey)""",
}

# which CTEs each CTE needs (emitted first)
CTE_DEPS = {
    "decl_spans": ["states"],
    "impact_spans": ["states"],
    "county_dim": ["decl_spans"],
    "star_locations": ["states"],
}


def with_ctes(names: list[str], body: str, extra: list[str] | None = None) -> str:
    """``WITH`` clause holding ``names`` (and what they need, in order) plus
    query-specific CTE texts in ``extra``, followed by ``body``."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in CTE_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [CTE[n] for n in order] + list(extra or [])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
