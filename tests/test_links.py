"""Ids of the filled event map and their first days, found on spans, against the day map itself."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventweave.operators import keys as ky
from eventweave.operators import spans as sp

DAY0 = dt.date(2001, 1, 1)


def spans(rng, n, name, unique):
    rows = []
    for i in range(n):
        b = rng.randrange(60)
        length = rng.choice([-1, 0, 0, 1, 2, 4, 9, 25, None])
        rows.append((f"{name}{i if unique else rng.randrange(n)}_{rng.randrange(3)}", rng.choice(["TX", "TX", "OK", None]), rng.choice(["x", "x", "y", None]),
                     DAY0 + dt.timedelta(b), None if length is None else DAY0 + dt.timedelta(b + length)))
    return rows


def by_days(a, b):
    em = sp.event_map(sp.expand_days(a).select("Day", "state", "county", "femaID"), sp.expand_days(b).select("Day", "state", "county", "emdatID"))
    filled = ky.fill_updown(em, "femaID", "emdatID", ["Day", "emdatID asc nulls last"], fill_null_key=False)
    return filled.groupBy("femaID", "emdatID", "state").agg(F.min("Day").alias("Day"))


@pytest.mark.parametrize("seed", range(6))
def test_first_links_are_those_of_the_filled_day_map(spark, seed):
    rng = random.Random(seed)
    n_a, n_b = [(40, 40), (80, 20), (15, 120), (60, 60), (1, 50), (50, 1)][seed]
    a = spark.createDataFrame(spans(rng, n_a, "D", True), "femaID string, state string, county string, begin_date date, end_date date")
    b = spark.createDataFrame(spans(rng, n_b, "E", seed % 2 == 0), "emdatID string, state string, county string, begin_date date, end_date date")
    links, days = ky.first_links(a, b), by_days(a, b)
    got, expected = (sorted(map(str, x.select("femaID", "emdatID", "state", "Day").collect())) for x in (links, days))
    assert got == expected and got


def test_gaps_go_to_the_next_id_and_ends_to_the_previous(spark):
    day = lambda i: DAY0 + dt.timedelta(i)
    a = spark.createDataFrame([("D_1", "TX", "x", day(0), day(20))], "femaID string, state string, county string, begin_date date, end_date date")
    b = spark.createDataFrame(
        [("E9", "TX", "x", day(3), day(4)), ("E5", "TX", "x", day(3), day(3)), ("E7", "TX", "x", day(8), day(9)), ("E8", "TX", "x", day(10), day(30)), ("E6", "TX", "y", day(1), day(1))],
        "emdatID string, state string, county string, begin_date date, end_date date",
    )
    got = {(r.femaID, r.emdatID): r.Day for r in ky.first_links(a, b).collect()}
    assert got == {("D_1", "E5"): day(0), ("D_1", "E9"): day(3), ("D_1", "E7"): day(5), ("D_1", "E8"): day(10), (None, "E8"): day(21), (None, "E6"): day(1)}


def test_no_days_no_loops_and_empty_sides(spark):
    schema = "state string, county string, begin_date date, end_date date"
    a = spark.createDataFrame([("D_1", "TX", "x", DAY0, DAY0)], f"femaID string, {schema}")
    b = spark.createDataFrame([("E", "TX", "x", DAY0, DAY0)], f"emdatID string, {schema}")
    links = ky.first_links(a, b)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "INTERVAL '1' DAY" not in plan
    assert [tuple(r) for r in ky.first_links(a, b.limit(0)).collect()] == [("D_1", None, "TX", DAY0)]
    assert [tuple(r) for r in ky.first_links(a.limit(0), b).collect()] == [(None, "E", "TX", DAY0)]
    assert ky.first_links(a.limit(0), b.limit(0)).count() == 0
