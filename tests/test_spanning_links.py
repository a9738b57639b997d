"""Links that span the classes of overlapping spans (F6): one a span at most, classes as of all pairs."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from eventweave.operators import keys as ky
from eventweave.operators.components import connected_components

from .test_classes import plain_roots

SCHEMA = "{} string, state string, county string, begin_date date, end_date date"


def spans(spark, rng, id_col, n, days, longest):
    day = lambda k: dt.date(2001, 1, 1) + dt.timedelta(days=k)
    rows = []
    for i in range(n):
        b = rng.randrange(days)
        state, county = rng.choice(["TX", "LA", None]), rng.choice(["c1", "c2", None])
        rows.append((rng.choice([f"{id_col[0]}{i}", f"{id_col[0]}{i // 3}", None]), state, county, day(b), day(b + rng.randrange(-1, longest))))
    return spark.createDataFrame(rows, SCHEMA.format(id_col))


@pytest.mark.parametrize("days,longest", [(600, 12), (200, 6), (30, 20)])
def test_spanning_links_have_the_classes_of_all_pairs(spark, days, longest):
    rng = random.Random(days)
    a, b = spans(spark, rng, "femaID", 90, days, longest), spans(spark, rng, "emdatID", 90, days, longest)
    every = ky.link_ids(a, b, ["state", "county"], ["county"]).dropna().collect()
    few = ky.link_ids(a, b, ["state", "county"], ["county"], spanning=True).collect()
    named = lambda rows: plain_roots([(f"femaID:{r.femaID}", f"emdatID:{r.emdatID}") for r in rows])
    assert named(few) == named(every) and every


def test_a_busy_place_has_no_more_links_than_spans(spark):
    rows = "SELECT concat('{}', id) AS {}, 'TX' AS state, 'c1' AS county, DATE'2001-01-01' AS begin_date, DATE'2001-01-09' AS end_date FROM range(300)"
    a, b = spark.sql(rows.format("D", "femaID")), spark.sql(rows.format("E", "emdatID"))
    links = ky.link_ids(a, b, ["state", "county"], ["county"], spanning=True)
    assert links.count() <= 600
    roots = connected_components(links.selectExpr("femaID AS a", "emdatID AS b"))
    assert roots.select("root").distinct().count() == 1 and roots.count() == 600
