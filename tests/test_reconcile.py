"""Reconcile (A49) on spans, against the day tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventweave.operators import analytics as an
from eventweave.operators import spans as sp

DAY0 = dt.date(2001, 1, 1)


def tables(spark, seed):
    rng = random.Random(seed)

    def row(i, name, unique):
        b = DAY0 + dt.timedelta(rng.randrange(40))
        length = rng.choice([-1, 0, 0, 1, 2, 5, 20, None])
        return (f"{name}{i if unique else rng.randrange(25)}", rng.choice(["TX", "TX", "OK", None]), rng.choice(["x", "y", None]),
                rng.choice(["R:a", "R:b", "N:a", None]), b, None if length is None else b + dt.timedelta(length))

    frame = lambda rows, c: spark.createDataFrame(rows, f"{c} string, state string, county string, incident_type string, begin_date date, end_date date")
    b = [row(i, "E", False) for i in range(70)]
    return frame([row(i, "D", True) for i in range(60)], "femaID"), frame(b + b[:10], "emdatID")


def by_days(a, b):
    days = sp.expand_days(b)
    events = days.filter("state = 'TX' AND incident_type RLIKE '^R:'").groupBy("emdatID", "state", "incident_type").agg(F.min("Day").alias("event_start"), F.max("Day").alias("event_end"))
    em = sp.event_map(sp.expand_days(a).select("Day", "state", "county", "femaID"), days.select("Day", "state", "county", "emdatID"))
    links = em.filter("state = 'TX'").select("femaID", "emdatID").distinct()
    rows = a.filter("state = 'TX'").select("femaID", F.col("incident_type").alias("a_type"), F.col("begin_date").alias("a_begin"), F.col("end_date").alias("a_end")).distinct()
    return events.join(links, "emdatID").join(rows, "femaID")


NAMES = ["emdatID", "state", "incident_type", "event_start", "event_end", "femaID", "a_type", "a_begin", "a_end"]


@pytest.mark.parametrize("seed", range(3))
def test_reconcile_equals_the_day_tables(spark, seed):
    a, b = tables(spark, seed)
    got, expected = (sorted(map(str, x.select(NAMES).collect())) for x in (an.reconcile(b, a, {"state": "TX"}, "^R:"), by_days(a, b)))
    assert got == expected and got


def test_links_are_not_shuffled(spark):
    a, b = tables(spark, 0)
    plan = an.reconcile(b, a, {"state": "TX"}, "^R:")._jdf.queryExecution().optimizedPlan().toString()
    # the match of the two sources is the last join, and nothing is grouped above it
    assert "Aggregate" not in plan.split("Join Inner", 1)[0]


def test_event_map_carries_columns(spark):
    rows = "Day date, state string, county string"
    a = spark.createDataFrame([(DAY0, "TX", "x", "D1", 7)], f"{rows}, femaID string, n int")
    b = spark.createDataFrame([(DAY0, "TX", "x", "E1", "p"), (DAY0, "OK", "x", "E2", "q")], f"{rows}, emdatID string, m string")
    got = sp.event_map(a, b, a_carry=("n",), b_carry=("m",)).select("femaID", "emdatID", "n", "m").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("D1", "E1", 7, "p"), (None, "E2", None, "q")], key=str)
