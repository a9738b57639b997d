"""A refresh of the published tables equals a rebuild, and leaves untouched years' files alone."""

import glob
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from eventweave.plans import base
from eventweave.plans import published as pb
from eventweave.plans.q_keys import AMBIGUOUS_PARENTS, EMDAT_RULES, FEMA_RULES, _hierarchy
from eventweave.plans.star_schema import build_star_schema, refresh_star_schema
from tests.conftest import SF001


def files_by_year(folder):
    out = {}
    for name in pb.TABLES:
        for f in glob.glob(f"{folder}/{name}/Year=*/*.parquet"):
            out.setdefault(re.search(r"Year=(\w+)", f).group(1), set()).add((f, os.path.getmtime(f)))
    return out


def rows_of(tables):
    return {n: sorted(map(str, tables[n].select(*sorted(tables[n].columns)).collect())) for n in pb.TABLES}


@pytest.fixture(scope="module")
def sources(spark):
    decl = base.decl_spans(spark, SF001).drop("rowkey").filter("state < 'C'")
    imp = base.impact_spans(spark, SF001).drop("rowkey").filter("state < 'C'")
    given = (base.county_dim(spark, SF001).filter("state < 'C'"), _hierarchy(spark), FEMA_RULES, EMDAT_RULES)
    return decl, imp, given


def test_a_refresh_is_a_rebuild_that_leaves_other_years_alone(spark, sources):
    decl, imp, given = sources
    how = dict(ambiguous_parents=AMBIGUOUS_PARENTS, last_begin="2010-01-01")
    # imputed ends are means over all rows of a state: give every declaration its end, so that only new rows change
    decl = decl.withColumn("end_date", F.coalesce("end_date", "begin_date"))
    first_decl, first_imp = decl.filter("begin_date < '2000-07-01'"), imp.filter("begin_date < '2000-07-01'")
    folder = tempfile.mkdtemp()
    build_star_schema(first_decl, first_imp, *given, out_dir=folder, buckets=3, **how)
    before = files_by_year(folder)
    stored = spark.createDataFrame(spark.read.parquet(f"{folder}/allKeys").collect(), spark.read.parquet(f"{folder}/allKeys").schema)
    years = refresh_star_schema(folder, decl, imp, *given, **how)
    after = files_by_year(folder)
    years = [y for y in years if y is not None]
    assert {2000, 2001} <= set(years)  # and years of older events that a new row belongs to
    untouched = [y for y in before if y.isdigit() and int(y) not in years]
    assert len(untouched) >= 2 and all(before[y] == after[y] for y in untouched)
    assert all(not before.get(str(y), set()) & after[str(y)] for y in years if str(y) in after)
    # the same as publishing anew with the stored keys
    anew = tempfile.mkdtemp()
    rebuilt = build_star_schema(decl, imp, *given, out_dir=anew, buckets=3, existing=stored, **how)
    found = pb.open_published(spark, folder)
    assert rows_of(found) == rows_of(rebuilt)
    keys = {tuple(r) for r in spark.read.parquet(f"{folder}/allKeys").collect()}
    assert keys == {tuple(r) for r in spark.read.parquet(f"{anew}/allKeys").collect()}
    kept = {(r.smashedID, r.state): r.eventKey for r in stored.collect()}
    assert all(k == kept[s, st] for _, _, s, st, k in keys if (s, st) in kept)
    plan = pb.search_published(found, year=2000)
    plan.collect()
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # nothing new: nothing is written
    again = files_by_year(folder)
    assert refresh_star_schema(folder, decl, imp, *given, **how) == []
    assert files_by_year(folder) == again


def test_an_event_that_moves_or_goes_leaves_its_old_year(spark):
    types = lambda *k: spark.createDataFrame([(x, "t", "h", "c") for x in k], "eventKey string, incident_type string, hazard_type string, hazard_cluster string")
    dates = lambda **k: spark.createDataFrame([*k.items()], "eventKey string, d string").selectExpr("eventKey", "cast(d AS date) AS eventStart", "cast(d AS date) AS eventEnd")
    rest = {
        "disastCasualties": spark.createDataFrame([("a", 1.0, 1.0)], "eventKey string, nKilled double, nWounded double"),
        "disastLocations": spark.createDataFrame([("a", "TX", "x"), ("b", "TX", "y")], "eventKey string, state string, county string"),
    }
    folder = tempfile.mkdtemp()
    pb.publish({"disastTypes": types("a", "b", "n"), "disastDates": dates(a="1999-01-01", b="2001-01-01"), **rest}, folder, 2)
    now = {"disastTypes": types("a", "n"), "disastDates": dates(a="2001-05-05"), "disastCasualties": rest["disastCasualties"], "disastLocations": rest["disastLocations"].filter("eventKey = 'a'")}
    touched = spark.createDataFrame([("a",), ("b",)], "eventKey string")
    assert pb.refresh(now, touched, folder) == [None, 1999, 2001]
    found = pb.open_published(spark, folder)
    anew = tempfile.mkdtemp()
    assert rows_of(found) == rows_of(pb.publish(now, anew, 2))
    assert not os.path.exists(f"{folder}/disastDates/Year=1999")


def test_rows_that_only_one_version_has(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 3)], "id string, n int")
    new = spark.createDataFrame([("a", 1), ("b", None), ("c", 4), ("d", 5)], "id string, n int")
    assert sorted(r.id for r in pb.changed_rows(old, new, ["id"]).collect()) == ["a", "c", "d"]
    assert pb.changed_rows(new, new, ["id"]).count() == 0
