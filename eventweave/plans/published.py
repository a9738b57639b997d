"""The published layout of the star schema.

``disastDates``, ``disastCasualties``, ``disastTypes`` and ``disastLocations`` are written with the year in which
their event starts as partition column, bucketed and sorted by ``eventKey``.  A search for
one year then reads that year's folders of every table, and its three joins and the final
``distinct`` stay inside the buckets: no exchange.

The number of buckets is fixed when a table is first written (``buckets_for`` sizes it), and kept in the layout
table beside the data, so that any session can open the tables again.  Events without a known
start are in the folder of the null year.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import join_null_safe
from ..session import ensure_checkpoint_dir, materialize
from ..sources.bucketed import open_bucketed, overwrite_partitions, table_name, write_bucketed

KEY, YEAR = "eventKey", "Year"
#: bytes of one bucket of a year's largest table
BUCKET_BYTES = 128 << 20
#: rows of a bucket, over all years, of the largest table
BUCKET_ROWS = 1 << 20
TABLES = ("disastDates", "disastCasualties", "disastTypes", "disastLocations")


def buckets_for(total_bytes: int, years: int = 1) -> int:
    """A number of buckets that keeps a bucket of one year near ``BUCKET_BYTES``."""
    return max(1, math.ceil(total_bytes / max(years, 1) / BUCKET_BYTES))


def buckets_for_rows(rows: int, least: int = 1) -> int:
    """A number of buckets that keeps a bucket, read over all years by one task, at ``BUCKET_ROWS`` rows or fewer on average."""
    return max(least, math.ceil(rows / BUCKET_ROWS))


def new_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex[:8]}"


def publish(tables: dict[str, DataFrame], folder: str, buckets: int) -> dict[str, DataFrame]:
    """Write the four event tables in the published layout; every other table plainly.

    The start year comes from ``disastDates``; the other tables take it by one join on their key."""
    spark = tables["disastDates"].sparkSession
    out, layout = {}, []
    dates = tables["disastDates"].withColumn(YEAR, F.year("eventStart"))
    years = None
    for name in (*TABLES, *(n for n in tables if n not in TABLES)):
        path = f"{folder.rstrip('/')}/{name}"
        if name not in TABLES:
            tables[name].write.mode("overwrite").parquet(path)
            out[name] = spark.read.schema(tables[name].schema).parquet(path)
            continue
        rows = dates if name == "disastDates" else tables[name].join(years, KEY, "left")
        out[name] = write_bucketed(rows, path, KEY, buckets, YEAR)
        years = out["disastDates"].select(KEY, YEAR)
        layout.append((name, buckets, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out[name].schema)))
    spark.createDataFrame(layout, "name string, buckets int, columns string").coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/_layout")
    return out


def open_published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four event tables below ``folder``, with their buckets, in a new session."""
    at = folder.rstrip("/")
    return {r["name"]: open_bucketed(spark, f"{at}/{r['name']}", r["columns"], KEY, r["buckets"], YEAR) for r in _layout(spark, folder)}


def changed_rows(old: DataFrame, new: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of ``columns`` in the rows that only one of two versions of a table has, repeats counted."""
    count = F.count(F.lit(1))
    a = old.select(*new.columns).groupBy(*new.columns).agg(count.alias("n_old"))
    b = new.groupBy(*new.columns).agg(count.alias("n_new"))
    left, right = a.withColumn("n_new", F.lit(0)), b.withColumn("n_old", F.lit(0)).select(*a.columns, "n_new")
    both = left.unionByName(right).groupBy(*new.columns).agg(F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new"))
    return both.filter("n_old <> n_new").select(*columns).distinct()


def refresh(tables: dict[str, DataFrame], touched: DataFrame, folder: str) -> list[int | None]:
    """Bring the published tables below ``folder`` up to ``tables``, of which only events ``touched`` (eventKey)
    changed; the years written.

    A touched event can change the year it starts in, so the years are those of touched events before and after.
    Only these years' rows are computed for the three tables that follow the dates, and only their partitions are
    overwritten: files of other years stay as they are.  The result equals publishing ``tables`` anew."""
    spark = touched.sparkSession
    touched = materialize(touched.select(KEY).distinct(), "touched")
    published = open_published(spark, folder)
    buckets = {r["name"]: r["buckets"] for r in _layout(spark, folder)}
    dates = materialize(tables["disastDates"].withColumn(YEAR, F.year("eventStart")), "refreshed_dates")
    seen = touched.join(dates, KEY).select(YEAR)
    for name in TABLES:
        seen = seen.unionByName(touched.join(published[name], KEY).select(YEAR))
    years = {r[0] for r in seen.distinct().collect()}  # one row a year
    if not touched.join(dates, KEY, "left_anti").isEmpty():
        years.add(None)  # what is left of an event without dates is there
    years = sorted(years, key=lambda y: (y is not None, y))
    here = spark.createDataFrame([(y,) for y in years], f"{YEAR} int")
    for name in TABLES:
        rows = dates if name == "disastDates" else tables[name].join(dates.select(KEY, YEAR), KEY, "left")
        # the rows may be computed from anything but the partitions they replace
        rows = materialize(join_null_safe(rows, here, [YEAR], "left_semi") if years else rows.limit(0), f"refreshed_{name}")
        overwrite_partitions(table_name(published[name]), f"{folder.rstrip('/')}/{name}", rows, KEY, buckets[name], YEAR, years)
    return years


def _layout(spark: SparkSession, folder: str) -> list:
    return spark.read.schema("name string, buckets int, columns string").parquet(f"{folder.rstrip('/')}/_layout").collect()  # four rows


def search_published(
    tables: dict[str, DataFrame], year: int | None = None, state: str | None = None, incident_type: str | None = None
) -> DataFrame:
    """A46 on the published tables: same rows as :func:`~eventweave.operators.analytics.search_events`.

    An event has one year, so the year filters each table before the joins; they are sort-merge
    joins on the bucket key, at any size of the sides."""

    def part(name: str, *conditions: Column | None) -> DataFrame:
        t = tables[name]
        for c in (F.col(YEAR) == year if year is not None else None, *conditions):
            t = t if c is None else t.filter(c)
        return t if name == "disastDates" else t.drop(YEAR)

    is_type = F.col("incident_type") == incident_type if incident_type is not None else None
    in_state = F.col("state") == state if state is not None else None
    dates, casualties = part("disastDates"), part("disastCasualties")
    places = part("disastLocations", in_state)
    found = part("disastTypes", is_type)
    found = found.join(dates.hint("merge"), KEY, "left" if year is None else "inner")
    found = found.join(casualties.hint("merge"), KEY, "left")
    found = found.join(places.hint("merge"), KEY, "left" if state is None else "inner")
    return found.select(*[c for c in found.columns if c != YEAR], YEAR).distinct()


def units_published(tables: dict[str, DataFrame], units: list[str], cluster: str) -> DataFrame:
    """A47 on the published tables: units affected per year by events of one hazard cluster.  Types and places meet
    in their buckets; the year is a column of either."""
    typed = tables["disastTypes"].filter(F.col("hazard_cluster") == cluster).select(KEY).distinct()
    places = tables["disastLocations"].select(KEY, *units, YEAR)
    hit = places.join(typed.hint("merge"), KEY, "left_semi").select(*units, YEAR).distinct()
    return hit.groupBy(YEAR).agg(F.count(F.lit(1)).cast("long").alias("Count"))
