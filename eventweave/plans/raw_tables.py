"""Raw feeds -> published tables in one run.

Declarations, incidents and impacts go through their normalizers, impacts get clean
places from their location text, and everything feeds ``build_star_schema``.
Declarations and incidents are the two kinds of source records on the first side of the
event map; impacts are the other side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule
from ..operators import cleaning, geo, text
from .star_schema import build_star_schema


def places_of_impacts(
    impacts: DataFrame,
    gazetteer: DataFrame,
    assignments: DataFrame,
    state_rules: list[Rule],
    noise_words: list[str] | None = None,
    patches: DataFrame | None = None,
) -> DataFrame:
    """(eventid, state, county): clean places of ``impacts(eventid, Location)``.

    Location text is patched, lower-cased, its state names rewritten to codes and noise words
    stripped; then it is parsed and matched.  A state-only entry has a NULL county, and so has a
    region that is in neither the gazetteer nor the assignments: its state is known."""
    t = impacts.select("eventid", "Location").distinct()
    if patches is not None:
        t = text.apply_patches(t, "eventid", patches, "Location")
    t = text.rewrite(t.withColumn("Location", F.lower("Location")), "Location", state_rules)
    if noise_words:
        t = text.strip_tokens(t, "Location", noise_words)
    # dots go on both sides: the gazetteer writes "st clair", a report "St. Clair"
    t = t.withColumn("Location", F.regexp_replace("Location", r"\.", ""))
    gazetteer = gazetteer.select("state_id", *[F.regexp_replace(F.lower(c), r"\.", "").alias(c) for c in ("city", "county_name")])
    parsed = geo.partition_by_presence(text.parse_locations(t, "eventid"))
    ids = F.concat_ws("_", "eventid", F.col("piece_no").cast("string"), F.col("region_no").cast("string"))
    rows = text.state_codes(parsed.withColumn("region_id", ids))
    found = geo.clean_places(rows, gazetteer, assignments, unassigned=True).select(F.col("region_id"), F.col("State").alias("state"), "county")
    named = found.join(rows.select("region_id", "eventid").distinct(), "region_id").select("eventid", "state", "county")
    # an entry that names only states stands for them whole; blanks beside named places of the state do not
    bare = rows.filter((F.col("presence") == "none") & F.col("State").isNotNull()).select("eventid", F.col("State").alias("state")).distinct()
    bare = bare.join(rows.filter("presence != 'none'").select("eventid", F.col("State").alias("state")).distinct(), ["eventid", "state"], "left_anti")
    return named.distinct().unionByName(bare.withColumn("county", F.lit(None).cast("string")))


def build_from_raw(
    declarations_raw: DataFrame,
    incidents_raw: DataFrame,
    impacts_raw: DataFrame,
    states: DataFrame,
    gazetteer: DataFrame,
    assignments: DataFrame,
    hierarchy: DataFrame,
    declaration_rules: list[Rule],
    impact_rules: list[Rule],
    state_rules: list[Rule],
    noise_words: list[str] | None = None,
    patches: DataFrame | None = None,
    city_aliases: dict[str, str] | None = None,
    drop_impacts: list[str] | None = None,
    allowed: list[str] | None = None,
    **options,
) -> dict[str, DataFrame]:
    """The published tables (see ``build_star_schema``, which takes ``options``)."""
    columns = ["Source", "eventid", "begin_date", "end_date", "state", "county", "incident_type", "nkill", "nwound"]
    declared = cleaning.normalize_declarations(declarations_raw)
    incidents = cleaning.add_county(cleaning.normalize_incidents(incidents_raw, states), gazetteer, city_aliases)
    first = cleaning.clean_admin(cleaning.union_sources(declared, incidents.drop("city")), allowed).select(*columns)
    gaz = gazetteer.select("state_id", *[F.regexp_replace(F.lower(c), r"\.", "").alias(c) for c in ("city", "county_name")])
    impacts = cleaning.normalize_impacts(impacts_raw, drop_ids=drop_impacts)
    places = places_of_impacts(impacts, gaz, assignments, state_rules, noise_words, patches)
    second = cleaning.clean_admin(geo.attach_places(impacts.drop("Location"), places, "eventid"), allowed).select(*columns)
    counties = gaz.select(F.col("state_id").alias("state"), F.col("county_name").alias("county")).distinct()
    return build_star_schema(first, second, counties, hierarchy, declaration_rules, impact_rules, **options)
