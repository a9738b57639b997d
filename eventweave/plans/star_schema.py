"""Build the eight published tables from normalized source spans.

declarations (+ incidents) and impacts, as span tables
``Source, eventid, begin_date, end_date, state, county, incident_type, nkill, nwound``
(the output of the normalizers, places already attached), become

* ``allKeys``       femaID, emdatID, smashedID, state, eventKey
* ``disastDates``   eventKey, eventStart, eventEnd
* ``disastLocations`` eventKey, state, county
* ``disastCasualties`` eventKey, nKilled, nWounded
* ``disastTypes``   eventKey, incident_type, hazard_type, hazard_cluster
* ``fema_hazard_cluster`` / ``emdat_hazard_cluster``  Source, incident_type, hazard_cluster
* ``hazard_report`` the hierarchy as given

Stages are written once under ``spark.checkpoint.dir`` (spans, linked ids, keys) the way the reference saves files between its scripts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule
from ..operators import keys as ky
from ..operators import marts as mt
from ..operators import spans as sp
from ..operators.cleaning import sequence_id
from ..operators.geo import expand_counties
from ..session import cut_lineage, materialize
from .published import TABLES, changed_rows, publish, refresh


SOURCE_COLUMNS = ["id", "begin_date", "end_date", "state", "county", "incident_type", "nkill", "nwound"]


def _source_rows(declarations: DataFrame, impacts: DataFrame) -> DataFrame:
    """The numbered rows that the published tables were made from, kept beside them for the next refresh."""
    a = declarations.withColumn("id", F.col("femaID")).select(*SOURCE_COLUMNS)
    return a.unionByName(impacts.withColumn("id", F.col("emdatID")).select(*SOURCE_COLUMNS))


def refresh_star_schema(folder: str, declarations: DataFrame, impacts: DataFrame, *given, **options) -> list[int | None]:
    """Bring the published layout in ``folder`` up to date with the sources as they are now; the years written.

    Stored events keep their keys.  Touched are the events whose key rows are new or gone, and those of any id whose
    source rows changed; ``published.refresh`` rewrites the years of these events alone."""
    spark, at = declarations.sparkSession, folder.rstrip("/")
    stored = materialize(spark.read.parquet(f"{at}/allKeys"), "stored_keys")
    sources = materialize(spark.read.parquet(f"{at}/_sources"), "stored_sources")
    tables = build_star_schema(declarations, impacts, *given, existing=stored, **options)
    keys, rows = tables["allKeys"], materialize(tables.pop("_sources"), "new_sources")
    ids = changed_rows(sources, rows, ["id"])
    every = keys.unionByName(stored.select(*keys.columns))
    named = every.select(F.explode(F.array("femaID", "emdatID")).alias("id"), "eventKey").filter("id <> ''").distinct()
    touched = changed_rows(stored, keys, ["eventKey"]).unionByName(named.join(ids, "id", "left_semi").select("eventKey"))
    years = refresh(tables, touched, folder)
    for name in tables:
        if name not in TABLES:
            tables[name].write.mode("overwrite").parquet(f"{at}/{name}")
    rows.write.mode("overwrite").parquet(f"{at}/_sources")
    return years


def build_star_schema(
    declarations: DataFrame,
    impacts: DataFrame,
    counties: DataFrame,
    hierarchy: DataFrame,
    fema_rules: list[Rule],
    emdat_rules: list[Rule],
    ambiguous_parents: list[tuple[str, str]] | None = None,
    exclude_types: tuple[str, ...] = ("Biological",),
    last_begin: str = "2020-01-20",
    out_dir: str | None = None,
    buckets: int | None = None,
    existing: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The eight tables; written below ``out_dir`` if given: plainly, or with ``buckets`` in the published layout
    (``published.py``: start year folders, that many buckets by event key).  ``existing``: the stored key
    table, whose keys stay as they are."""
    # declarations: impute missing ends (state+year, then state), drop excluded
    # types / late spans, number rows within each declaration (pad 3)
    d = declarations.withColumn("year", F.year("begin_date"))
    d = sp.impute_end(d, [["state", "year"], ["state"]]).withColumn("end_date", F.col("end_imputed"))
    d = sp.exclude(d.drop("end_imputed", "duration", "year"), list(exclude_types), last_begin)
    d = sequence_id(d, "eventid", ["begin_date", "state", "county", "end_date"], 3, out="femaID")
    d = cut_lineage(d, "declarations")
    # impacts: one id per place row (pad 4); county-less rows cover the state
    i = sequence_id(impacts, "eventid", ["begin_date", "state", "county", "end_date"], 4, out="emdatID")
    i = cut_lineage(expand_counties(i, counties), "impacts")

    comp = cut_lineage(ky.composite_id(ky.first_links(d, i)), "linked_ids")
    keys = cut_lineage(ky.mint_keys(comp, existing=existing, grouped=True), "keys")

    key_map = (
        keys.filter(F.col("femaID") != "").select(F.col("femaID").alias("id"), "eventKey")
        .unionByName(keys.filter(F.col("emdatID") != "").select(F.col("emdatID").alias("id"), "eventKey"))
        .distinct()
    )
    spans = d.select(F.col("femaID").alias("id"), "begin_date", "end_date").unionByName(
        i.select(F.col("emdatID").alias("id"), "begin_date", "end_date")
    )
    places = d.select(F.col("femaID").alias("id"), "state", "county").unionByName(
        i.select(F.col("emdatID").alias("id"), "state", "county")
    )
    dates = mt.build_dates(spans, key_map, "id")
    locations = mt.build_locations(places, key_map, "id")
    casualties = mt.build_casualties(
        d.select(F.col("femaID").alias("id"), "nkill", "nwound"), i.select(F.col("emdatID").alias("id"), "nkill", "nwound"), key_map, "id"
    )
    fema_typed = mt.attach_hierarchy(
        mt.classify(d.select(F.col("femaID").alias("id"), "Source", "incident_type"), "incident_type", fema_rules),
        hierarchy, drop_pairs=ambiguous_parents, fallback=True,
    )
    emdat_typed = mt.attach_hierarchy(
        mt.classify(i.select(F.col("emdatID").alias("id"), "Source", "incident_type"), "incident_type", emdat_rules),
        hierarchy, drop_pairs=ambiguous_parents, fallback=False,
    )
    types = mt.build_types([fema_typed, emdat_typed], key_map, "id")
    tables = {
        "allKeys": keys,
        "disastDates": dates,
        "disastLocations": locations,
        "disastCasualties": casualties,
        "disastTypes": types,
        "fema_hazard_cluster": fema_typed.select("Source", "incident_type", "hazard_cluster").distinct(),
        "emdat_hazard_cluster": emdat_typed.select("Source", "incident_type", "hazard_cluster").distinct(),
        "hazard_report": hierarchy,
    }
    if out_dir and buckets:
        written = publish(tables, out_dir, buckets)
        sources = f"{out_dir.rstrip('/')}/_sources"
        _source_rows(d, i).write.mode("overwrite").parquet(sources)
        return written
    if existing is not None:
        tables["_sources"] = _source_rows(d, i)
    if out_dir:
        spark = declarations.sparkSession
        for name, df in list(tables.items()):
            path = f"{out_dir.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(path)
            tables[name] = spark.read.parquet(path)
    return tables
