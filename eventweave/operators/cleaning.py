"""Source cleaning: normalize the three feeds into one span table.

Span grain: one row per source event x place, columns
``Source, eventid, begin_date, end_date, state, county, incident_type, nkill, nwound``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import compose_date, date_part, pad_counter
from .ordered import number_within

# The 52 admin codes kept for US records (50 states, DC, Puerto Rico).
US_ADMIN_CODES = [
    "AK", "AL", "AR", "AZ", "CA", "CO", "CT", "DC", "DE", "FL", "GA", "HI", "IA",
    "ID", "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MI", "MN", "MO", "MS",
    "MT", "NC", "ND", "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA",
    "PR", "RI", "SC", "SD", "TN", "TX", "UT", "VA", "VT", "WA", "WI", "WV", "WY",
]


def normalize_declarations(df: DataFrame, cutoff: str = "1990-01-01", source: str = "FEMA") -> DataFrame:
    """Rename, cut the county suffix from `` (``, keep the date before ``T``,
    keep begin >= cutoff, tag the source."""
    out = df.select(
        F.lit(source).alias("Source"),
        F.col("femaDeclarationString").alias("eventid"),
        date_part("incidentBeginDate").alias("begin_date"),
        date_part("incidentEndDate").alias("end_date"),
        F.col("state"),
        F.regexp_replace("designatedArea", r" \(.*", "").alias("county"),
        F.col("incidentType").alias("incident_type"),
    )
    return out.filter(F.col("begin_date") >= F.lit(cutoff).cast("date"))


def normalize_incidents(
    df: DataFrame,
    states: DataFrame,
    country: int = 217,
    min_killed: float = 3,
    cutoff: str = "1990-01-01",
    source: str = "GTD",
) -> DataFrame:
    """One country, at least ``min_killed`` deaths, date composed from parts
    (an impossible date is NULL and dropped by the cutoff), state name -> code."""
    kept = df.filter((F.col("country") == country) & (F.col("nkill") >= min_killed))
    spans = kept.select(
        F.lit(source).alias("Source"),
        F.col("eventid").cast("string").alias("eventid"),
        compose_date("iyear", "imonth", "iday").alias("begin_date"),
        F.col("provstate"),
        F.col("city"),
        F.col("attacktype1_txt").alias("incident_type"),
        F.col("nkill").cast("double").alias("nkill"),
        F.col("nwound").cast("double").alias("nwound"),
    ).withColumn("end_date", F.col("begin_date"))
    spans = spans.filter(F.col("begin_date") >= F.lit(cutoff).cast("date"))
    return canonical_state(spans, "provstate", states, out="state").drop("provstate")


def add_county(
    df: DataFrame,
    gazetteer: DataFrame,
    aliases: dict[str, str] | None = None,
    state: str = "state",
    city: str = "city",
) -> DataFrame:
    """City -> county on (state, city).  The gazetteer is reduced to one
    county per (state, city) first so the enrichment never multiplies rows."""
    aliases = aliases or {}
    c = F.col(city)
    for src, dst in aliases.items():
        c = F.when(F.col(city) == src, F.lit(dst)).otherwise(c)
    keyed = df.withColumn("__city_key", c)
    g = gazetteer.groupBy(F.col("state_id").alias("__g_state"), F.col("city").alias("__g_city")).agg(
        F.min("county_name").alias("county")
    )
    cond = (keyed[state] == g["__g_state"]) & (keyed["__city_key"] == g["__g_city"])
    return keyed.join(g, cond, "left").drop("__g_state", "__g_city", "__city_key")


def union_sources(*dfs: DataFrame) -> DataFrame:
    """Stack sources by column name; a source lacking a column gets NULLs."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def normalize_impacts(df: DataFrame, iso: str = "USA", drop_ids: list[str] | None = None, source: str = "EMDAT") -> DataFrame:
    """One country; deaths or injuries present; strip `` (AdmN).`` from the
    location text; missing start month/day -> 1/1, end -> 12/28; composite type
    ``type:subtype:subsubtype`` with missing parts written ``NA``."""
    kept = df.filter((F.col("ISO") == iso) & (F.col("`Total Deaths`").isNotNull() | F.col("`No Injured`").isNotNull()))
    if drop_ids:
        kept = kept.filter(~F.col("`Dis No`").isin(drop_ids))
    return kept.select(
        F.lit(source).alias("Source"),
        F.col("`Dis No`").alias("eventid"),
        compose_date("`Start Year`", F.coalesce("`Start Month`", F.lit(1)), F.coalesce("`Start Day`", F.lit(1))).alias(
            "begin_date"
        ),
        compose_date("`End Year`", F.coalesce("`End Month`", F.lit(12)), F.coalesce("`End Day`", F.lit(28))).alias(
            "end_date"
        ),
        F.regexp_replace("Location", r" \(Adm\d+\)\.?", "").alias("Location"),
        F.concat_ws(
            ":",
            F.coalesce("`Disaster Type`", F.lit("NA")),
            F.coalesce("`Disaster Subtype`", F.lit("NA")),
            F.coalesce("`Disaster Subsubtype`", F.lit("NA")),
        ).alias("incident_type"),
        F.col("`Total Deaths`").alias("nkill"),
        F.col("`No Injured`").alias("nwound"),
    )


def canonical_state(df: DataFrame, col: str, states: DataFrame, out: str = "state") -> DataFrame:
    """A column holding state names or codes -> code.

    Try name -> code, else code -> (name ->) code, else NULL.  ``states`` is the
    (state, abbr) dimension; the two lookups are joins Spark broadcasts once
    the dimension's measured size is under the broadcast threshold."""
    by_name = states.select(F.lower("state").alias("__n_key"), F.col("abbr").alias("__by_name"))
    by_code = states.select(F.upper("abbr").alias("__c_key"), F.col("abbr").alias("__by_code"))
    t = df.join(by_name, F.lower(df[col]) == by_name["__n_key"], "left")
    t = t.join(by_code, F.upper(t[col]) == by_code["__c_key"], "left")
    return t.withColumn(out, F.coalesce("__by_name", "__by_code")).drop("__n_key", "__by_name", "__c_key", "__by_code")


def clean_admin(
    df: DataFrame, allowed: list[str] | DataFrame | None = None, state: str = "state", county: str = "county"
) -> DataFrame:
    """Lower-case counties without dots; keep only allowed state codes
    (a code list, or a one-column table of codes for a semi join)."""
    allowed = allowed if allowed is not None else US_ADMIN_CODES
    t = df.withColumn(county, F.regexp_replace(F.lower(F.col(county)), r"\.", ""))
    if isinstance(allowed, DataFrame):
        codes = allowed.select(F.col(allowed.columns[0]).alias("__code")).distinct()
        return t.join(codes, t[state] == codes["__code"], "left_semi")
    return t.filter(F.col(state).isin(allowed))


def drop_listed(df: DataFrame, blocklist: DataFrame | list[str], key: str) -> DataFrame:
    """Remove rows whose ``key`` is on a blocklist (anti join)."""
    if isinstance(blocklist, list):
        # a code-given list: its size is known here, so broadcasting it is safe
        spark = df.sparkSession
        blocklist = F.broadcast(spark.createDataFrame([(v,) for v in blocklist], f"`{key}` STRING"))
    return df.join(blocklist.select(key).distinct(), on=key, how="left_anti")


def sequence_id(
    df: DataFrame,
    key: str,
    order: list[str | Column],
    width: int,
    out: str = "event_id",
    skew_safe: bool = True,
) -> DataFrame:
    """``key_0001`` style id: a counter within ``key`` in ``order``, padded
    to ``width`` but never truncated.  One declaration may cover thousands of
    counties, so numbering goes through the skew-safe scan."""
    numbered = number_within(df, [key], order, "__seq", skew_safe=skew_safe)
    return numbered.withColumn(out, F.concat(F.col(key), F.lit("_"), pad_counter("__seq", width))).drop("__seq")
