"""The published layout: bucketed joins without a shuffle, pruned years, the same answers."""

import glob
import re

import pytest

from eventweave.operators import analytics as an
from eventweave.plans import base, q_published
from eventweave.plans import published as pb
from eventweave.sources import bucketed
from tests.conftest import SF001


@pytest.fixture(scope="module")
def star(spark):
    return {
        "disastTypes": base.star_types(spark, SF001),
        "disastDates": base.star_dates(spark, SF001),
        "disastCasualties": base.star_casualties(spark, SF001),
        "disastLocations": base.star_locations(spark, SF001),
        "hazard_report": spark.createDataFrame([("a", "b")], "hazard_type string, hazard_cluster string"),
    }


@pytest.fixture(scope="module")
def folder(spark, star):
    at = pb.new_folder(spark)
    pb.publish(star, at, 8)
    return at


def executed(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def as_rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_a_search_of_a_year_has_no_exchange_and_prunes_years(spark, folder):
    tables = pb.open_published(spark, folder)
    found = pb.search_published(tables, year=1997, state="DS", incident_type="1-URGENT")
    plan = executed(found)
    assert found.count() > 0
    assert "Exchange" not in plan and "Broadcast" not in plan
    assert plan.count("SortMergeJoin") == 3
    scans = re.findall(r"FileScan parquet.*", plan)
    assert len(scans) == 4
    for scan in scans:
        assert re.search(r"PartitionFilters: \[[^\]]*Year#\d+ = 1997", scan), scan
        assert "Bucketed: true" in scan and "SelectedBucketsCount: 8 out of 8" in scan
    # only that year's files are read
    one = tables["disastTypes"].filter("Year = 1997")
    assert {re.search(r"Year=(\w+)", f).group(1) for (f,) in one.select("_metadata.file_path").distinct().collect()} == {"1997"}


def test_a_search_by_key_reads_one_bucket(spark, folder):
    tables = pb.open_published(spark, folder)
    plan = executed(pb.search_published(tables, year=1997).filter("eventKey = '33'"))
    assert plan.count("SelectedBucketsCount: 1 out of 8") == 4


def test_units_join_without_an_exchange_below_the_last_groups(spark, folder):
    plan = executed(pb.units_published(pb.open_published(spark, folder), ["state", "county"], "URGENT"))
    join = plan[plan.index("SortMergeJoin") :]
    assert "Exchange" not in join


@pytest.mark.parametrize(
    "how", [{}, {"year": 1996}, {"state": "EJ"}, {"year": 1997, "incident_type": "5-LOW"}, {"year": 1890}, {"state": "DS", "incident_type": "1-URGENT"}]
)
def test_answers_are_those_of_the_plain_tables(spark, star, folder, how):
    plain = an.search_events(star["disastTypes"], star["disastDates"], star["disastCasualties"], star["disastLocations"], **how)
    assert as_rows(pb.search_published(pb.open_published(spark, folder), **how)) == as_rows(plain)


def test_events_without_dates_places_or_casualties(spark):
    types = spark.createDataFrame([("a", "x", "h", "c"), ("b", "x", "h", "c"), ("c", "y", "h", "c")], "eventKey string, incident_type string, hazard_type string, hazard_cluster string")
    dates = spark.sql("SELECT 'a' AS eventKey, DATE'2001-12-31' AS eventStart, DATE'2002-01-02' AS eventEnd UNION ALL SELECT 'c', NULL, NULL")
    killed = spark.createDataFrame([("b", 1.0, 2.0)], "eventKey string, nKilled double, nWounded double")
    places = spark.createDataFrame([("a", "TX", None), ("a", "TX", "b"), ("c", "TX", "b"), ("d", "TX", "b")], "eventKey string, state string, county string")
    tables = {"disastTypes": types, "disastDates": dates, "disastCasualties": killed, "disastLocations": places}
    at = pb.new_folder(spark)
    written = pb.publish(tables, at, 3)
    for how in ({}, {"year": 2001}, {"year": 2002}, {"state": "TX"}, {"incident_type": "x"}):
        plain = an.search_events(types, dates, killed, places, **how)
        assert as_rows(pb.search_published(written, **how)) == as_rows(plain), how
    none = {n: t.limit(0) for n, t in tables.items()}
    assert pb.search_published(pb.publish(none, pb.new_folder(spark), 3), year=2001).count() == 0


def test_files_one_a_bucket_and_tables_reopen(spark, folder):
    path = folder.removeprefix("file:")
    for name in pb.TABLES:
        for year in glob.glob(f"{path}/{name}/Year=*"):
            files = glob.glob(f"{year}/*.parquet")
            assert len(files) <= 8 and len({re.search(r"_(\d{5})\.", f).group(1) for f in files}) == len(files)
    again = pb.open_published(spark, folder)
    assert set(again) == set(pb.TABLES)
    counts = {n: t.count() for n, t in again.items()}
    assert all(counts.values())
    sizes = [r["n_rows"] for r in bucketed.rows_by_bucket(again["disastTypes"], "eventKey", 8).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    bucketed.forget(*again.values())
    assert {n: t.count() for n, t in pb.open_published(spark, folder).items()} == counts


def test_bucket_numbers_and_names():
    assert pb.buckets_for(0) == 1 and pb.buckets_for(10 * pb.BUCKET_BYTES, 5) == 2 and q_published.BUCKETS == 8
    with pytest.raises(ValueError):
        bucketed._quoted("a`; DROP TABLE b")
