"""Keys per class of linked ids: chains, hubs, and one key an event."""

import random

import pytest
from pyspark.sql import functions as F

from eventweave.operators import keys as ky
from eventweave.operators.components import connected_components
from eventweave.plans import q_keys
from tests.conftest import SF001

DAYS = "source string, id string, day date"


def plain_roots(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in root}


def classes(spark, pairs, days):
    pair_rows = spark.createDataFrame(pairs, "femaID string, emdatID string")
    rows = spark.createDataFrame(days, "source string, id string, day string").withColumn("day", F.col("day").cast("date"))
    return {(r["source"], r["id"]): (r["root"], r["eventKey"]) for r in ky.event_classes(pair_rows, rows).collect()}


def test_a_chain_is_one_event(spark):
    n = 300
    pairs = [(f"D{i:03}", f"E{i:03}") for i in range(n)] + [(f"D{i + 1:03}", f"E{i:03}") for i in range(n - 1)]
    random.Random(1).shuffle(pairs)
    days = [("femaID", f"D{i:03}", "2001-05-02") for i in range(n)] + [("emdatID", f"E{i:03}", "2001-04-30") for i in range(n)]
    got = classes(spark, pairs, days)
    assert len(got) == 2 * n and set(got.values()) == {("emdatID:E000", "2001_04_0001")}


def test_a_hub_its_repeats_and_its_neighbours(spark):
    pairs = [("HUB", f"E{i}") for i in range(2000)] * 2 + [("D1", "E1999"), ("D2", "X"), (None, "X"), ("D9", None)]
    days = [("femaID", "HUB", "2001-01-31"), ("femaID", "D1", "2000-12-31"), ("femaID", "D2", "2000-12-01"), ("femaID", "D9", "2000-12-05")]
    days += [("emdatID", f"E{i}", "2001-02-01") for i in range(2000)] + [("emdatID", "X", "2001-03-01"), ("emdatID", "ALONE", "2000-12-31"), ("emdatID", "NODAY", None)]
    got = classes(spark, pairs, days)
    assert len({got["femaID", "HUB"], got["femaID", "D1"], *(got["emdatID", f"E{i}"] for i in range(2000))}) == 1
    assert got["femaID", "D2"] == got["emdatID", "X"]
    keys = {got[k][1] for k in [("emdatID", "ALONE"), ("femaID", "HUB"), ("femaID", "D2"), ("femaID", "D9")]}
    # numbered in the month of the first day, by the smallest source:id
    assert got["emdatID", "ALONE"][1] == "2000_12_0001" and keys == {f"2000_12_000{i}" for i in (1, 2, 3, 4)}
    assert ("emdatID", "NODAY") not in got


def test_random_links_match_a_plain_union(spark):
    rng = random.Random(4)
    pairs = [(f"D{rng.randrange(400)}", f"E{rng.randrange(500)}") for _ in range(450)]
    days = sorted({("femaID", a, "2001-01-01") for a, _ in pairs} | {("emdatID", b, "2001-01-01") for _, b in pairs})
    got = classes(spark, pairs, days)
    roots = plain_roots([(f"femaID:{a}", f"emdatID:{b}") for a, b in pairs])
    assert {f"{s}:{i}": r for (s, i), (r, _) in got.items()} == roots
    assert len({k for _, k in got.values()}) == len(set(roots.values()))
    assert classes(spark, [], []) == {} and len(classes(spark, [], days)) == len(days)


def test_components_of_numbers(spark):
    links = [(i, i + 1) for i in range(0, 64)] + [(100, 200), (200, 100), (5, 5), (300, 300)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(65)}, 100: 100, 200: 100}


def test_links_of_spans_are_those_of_the_filled_map(spark):
    from eventweave.plans.q_keys import filled_map

    pairs, _ = q_keys._linked_ids(spark, SF001)
    filled = filled_map(spark, SF001).filter("femaID IS NOT NULL AND emdatID IS NOT NULL").select("femaID", "emdatID").distinct()
    assert pairs.exceptAll(filled).count() == 0 and filled.exceptAll(pairs).count() == 0 and pairs.count() > 0
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", ["overlap", "adjacent"])
def test_spans_of_a_place_link_only_by_a_common_day(spark, name):
    b = "2001-01-05" if name == "overlap" else "2001-01-06"
    a = spark.sql("SELECT 'D' AS femaID, 'TX' AS state, cast(NULL AS string) AS county, DATE'2001-01-01' AS begin_date, DATE'2001-01-05' AS end_date")
    e = spark.sql(f"SELECT 'E' AS emdatID, 'TX' AS state, cast(NULL AS string) AS county, DATE'{b}' AS begin_date, DATE'2001-02-09' AS end_date")
    assert ky.link_ids(a, e, ["state", "county"], ["county"]).count() == (name == "overlap")
    assert ky.link_ids(a, e, ["state", "county"]).count() == 0
