"""End to end: normalized spans from the driver tables -> eight tables -> search."""

import tempfile

from pyspark.sql import functions as F

from eventweave.operators import analytics as an
from eventweave.operators import keys as ky
from eventweave.plans import base, published
from eventweave.plans.q_keys import AMBIGUOUS_PARENTS, EMDAT_RULES, FEMA_RULES, _hierarchy
from eventweave.plans.star_schema import build_star_schema

from tests.conftest import SF001


def test_star_schema_end_to_end(spark):
    decl = base.decl_spans(spark, SF001).drop("rowkey")
    imp = base.impact_spans(spark, SF001).drop("rowkey")
    out = tempfile.mkdtemp()
    t = build_star_schema(
        decl, imp, base.county_dim(spark, SF001), _hierarchy(spark), FEMA_RULES, EMDAT_RULES,
        ambiguous_parents=AMBIGUOUS_PARENTS, exclude_types=("5-LOW",), last_begin="2001-06-30", out_dir=out,
    )
    assert set(t) == {
        "allKeys", "disastDates", "disastLocations", "disastCasualties", "disastTypes",
        "fema_hazard_cluster", "emdat_hazard_cluster", "hazard_report",
    }
    keys = t["allKeys"]
    assert keys.count() > 0
    assert ky.check_unique(t["disastDates"], ["eventKey"]).count() == 0
    assert ky.check_unique(t["disastCasualties"], ["eventKey"]).count() == 0
    # every published key row traces back to the key table
    known = keys.select("eventKey").distinct()
    for name in ("disastDates", "disastLocations", "disastCasualties", "disastTypes"):
        assert t[name].join(known, "eventKey", "left_anti").count() == 0, name
    # no excluded type survives, and dates are ordered
    assert t["disastTypes"].filter(F.col("incident_type") == "5-LOW").count() == 0
    assert t["disastDates"].filter(F.col("eventEnd") < F.col("eventStart")).count() == 0
    # the user query runs on the published tables
    row = t["disastDates"].join(t["disastLocations"], "eventKey").first()
    res = an.search_events(
        t["disastTypes"], t["disastDates"], t["disastCasualties"], t["disastLocations"],
        year=row.eventStart.year, state=row.state,
    )
    assert res.count() > 0


def test_star_schema_in_the_published_layout(spark):
    decl = base.decl_spans(spark, SF001).drop("rowkey").filter("state < 'C'")
    imp = base.impact_spans(spark, SF001).drop("rowkey").filter("state < 'C'")
    given = (decl, imp, base.county_dim(spark, SF001), _hierarchy(spark), FEMA_RULES, EMDAT_RULES)
    out = tempfile.mkdtemp()
    t = build_star_schema(*given, ambiguous_parents=AMBIGUOUS_PARENTS, last_begin="2001-06-30", out_dir=out, buckets=4)
    again = published.open_published(spark, out)
    for name in published.TABLES:
        assert again[name].count() == t[name].count() > 0
    row = t["disastDates"].join(t["disastLocations"], "eventKey").first()
    plain = an.search_events(
        *[again[n].drop("Year") for n in ("disastTypes", "disastDates", "disastCasualties", "disastLocations")], year=row.eventStart.year, state=row.state
    )
    found = published.search_published(again, year=row.eventStart.year, state=row.state)
    assert sorted(map(str, found.select(*plain.columns).collect())) == sorted(map(str, plain.collect())) != []
