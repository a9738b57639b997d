"""Places: completeness labels, gazetteer cascade, leftovers, county expansion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_blank, regex_trim


def partition_by_presence(df: DataFrame, region: str = "Region", county: str = "County", out: str = "presence") -> DataFrame:
    """One label for the four disjoint subsets (both, region only, county
    only, none) instead of four filtered copies of the data."""
    r, c = is_blank(region), is_blank(county)
    label = (
        F.when(~r & ~c, "both")
        .when(~r & c, "region_only")
        .when(r & ~c, "county_only")
        .otherwise("none")
    )
    return df.withColumn(out, label)


def label_regions(
    df: DataFrame, gazetteer: DataFrame, state: str = "State", region: str = "Region", look_up: Column | None = None
) -> DataFrame:
    """A17 in one pass: ``df`` with the ``county`` and ``level`` its region stands for.

    1. region is a county of the state -> itself, level ``county``;
    2. else region is a city of the state -> each county of that city, level ``city``;
    3. else NULL, NULL: a leftover.
    Only rows with a region for which ``look_up`` holds are looked up.  The dimensions are
    deduplicated first, so a join fans out only over the counties of a city."""
    wanted = ~is_blank(region) if look_up is None else ~is_blank(region) & look_up
    base = df.withColumn("__look", F.when(wanted, F.col(region)))
    counties = gazetteer.select(F.col("state_id").alias("__cs"), F.col("county_name").alias("__cn")).distinct()
    cities = gazetteer.select(
        F.col("state_id").alias("__gs"), F.col("city").alias("__city"), F.col("county_name").alias("__gc")
    ).distinct()
    j = base.join(counties, (base[state] == counties["__cs"]) & (base["__look"] == counties["__cn"]), "left")
    as_city = F.when(F.col("__cn").isNull(), F.col("__look"))
    j = j.withColumn("__look", as_city)
    j = j.join(cities, (j[state] == cities["__gs"]) & (j["__look"] == cities["__city"]), "left")
    level = F.when(F.col("__cn").isNotNull(), "county").when(F.col("__gc").isNotNull(), "city")
    j = j.withColumn("county", F.coalesce("__cn", "__gc")).withColumn("level", level)
    return j.drop("__look", "__cs", "__cn", "__gs", "__city", "__gc")


def match_gazetteer(
    df: DataFrame,
    gazetteer: DataFrame,
    id_col: str = "region_id",
    state: str = "State",
    region: str = "Region",
    presence: str = "presence",
) -> tuple[DataFrame, DataFrame]:
    """Cascade a free-text region against a gazetteer (state, city, county).

    Works on the rows that have a region and no county (``presence = region_only``, if ``df``
    has that label).  Returns (matched: id, state, region, county, level) and the
    leftovers: those rows whose (state, region) is neither a county nor a city."""
    rows = df.filter(F.col(presence) == "region_only") if presence in df.columns else df.filter(~is_blank(region))
    labelled = label_regions(rows.select(id_col, state, region), gazetteer, state, region)
    found = F.col("level").isNotNull()
    return labelled.filter(found), labelled.filter(~found).drop("county", "level")


def assign_leftovers(leftovers: DataFrame, assignments: DataFrame, id_col: str = "region_id", state: str = "State") -> DataFrame:
    """Hand assignment of county lists to leftover regions, re-exploded.

    ``assignments``: id_col, counties (comma-separated text)."""
    a = assignments.select(F.col(id_col).alias("__aid"), F.col("counties"))
    j = leftovers.join(a, leftovers[id_col] == a["__aid"], "inner")
    return j.select(
        id_col, state, F.col("Region"), F.explode(F.split("counties", ",")).alias("county"), F.lit("manual").alias("level")
    ).withColumn("county", regex_trim("county"))


def clean_places(
    df: DataFrame, gazetteer: DataFrame, assignments: DataFrame, id_col: str = "region_id", state: str = "State", region: str = "Region", known: str = "County", unassigned: bool = False
) -> DataFrame:
    """The clean geography in one pass over the parsed regions (with ``presence``, see A16):
    rows whose county was given (level ``known``), matched rows (``county``, ``city``) and hand-assigned
    leftovers (``manual``).  State-only rows have no place; ``unassigned`` keeps leftovers nobody
    assigned with their state and no county (level ``unassigned``), else they have none either."""
    rows = df.withColumnRenamed(known, "__known")
    labelled = label_regions(rows, gazetteer, state, region, F.col("presence") == "region_only")
    given = F.col("presence").isin("both", "county_only")
    open_ = (F.col("presence") == "region_only") & F.col("level").isNull()
    a = assignments.select(F.col(id_col).alias("__aid"), F.col("counties").alias("__counties"))
    j = labelled.withColumn("__open", F.when(open_, F.col(id_col))).join(a, F.col("__open") == F.col("__aid"), "left")
    counties = F.when(given, F.array("__known")).when(F.col("level").isNotNull(), F.array("county")).otherwise(F.split("__counties", ","))
    level = F.when(given, "known").when(F.col("level").isNotNull(), F.col("level")).otherwise("manual")
    if unassigned:
        nobody = open_ & F.col("__counties").isNull()
        counties = F.when(nobody, F.array(F.lit(None).cast("string"))).otherwise(counties)
        level = F.when(nobody, "unassigned").otherwise(level)
    return j.select(id_col, state, region, level.alias("level"), F.explode(counties).alias("county")).withColumn("county", regex_trim("county"))


def match_coverage(df: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows match the dimension on ``keys`` and how many do not."""
    d = dim.select(*keys).distinct().withColumn("__hit", F.lit(True))
    j = df.select(*keys).join(d, on=keys, how="left")
    return j.agg(
        F.count(F.when(F.col("__hit"), 1)).cast("long").alias("n_matched"),
        F.count(F.when(F.col("__hit").isNull(), 1)).cast("long").alias("n_unmatched"),
    )


def attach_places(events: DataFrame, places: DataFrame, key: str) -> DataFrame:
    """One event -> its many clean places (left join keeps place-less events)."""
    return events.join(places, on=key, how="left")


def expand_counties(df: DataFrame, counties: DataFrame, state: str = "state", county: str = "county") -> DataFrame:
    """Rows without a county stand for the whole state: give them one row
    per county of that state; rows with a county are kept as they are.

    An inner join from the rows (not from the gazetteer), so states without a
    county-less record produce nothing; AQE splits a hot state's partition."""
    dim = counties.select(F.col(state).alias("__ds"), F.col(county).alias("__dc")).distinct()
    blank = df.filter(is_blank(county))
    spread = blank.join(dim, blank[state] == dim["__ds"], "inner").withColumn(county, F.col("__dc")).drop("__ds", "__dc")
    return spread.unionByName(df.filter(~is_blank(county)))
