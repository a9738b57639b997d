"""The event map of spans (A28) and its filling (A32) against the day rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventweave.operators import keys as ky
from eventweave.operators import ordered
from eventweave.operators import spans as sp
from eventweave.session import materialize

SPAN = ("begin_date", "end_date")


def table(spark, rng, n, name, copies):
    rows = []
    for i in range(n):
        b = dt.date(1969, 12, 1) + dt.timedelta(rng.randrange(60))  # days before and after 1970-01-01
        length = rng.choice([-1, 0, 0, 1, 2, 4, 9, 25, None])
        where = (rng.choice(["TX", "TX", "OK", None]), rng.choice(["x", "x", "y", None]))
        rows.append((rng.choice([f"{name}{i}", f"{name}{i}", None]), *where, rng.choice([b, b, b, None]), None if length is None else b + dt.timedelta(length), i))
    return spark.createDataFrame(rows + rows[:copies], f"{name} string, state string, county string, begin_date date, end_date date, n_{name} int")


def sorted_rows(df, *names):
    return sorted(map(str, df.select("Day", "state", "county", "femaID", "emdatID", *names).collect()))


@pytest.mark.parametrize("seed", range(4))
def test_event_map_of_spans_is_that_of_their_days(spark, seed):
    rng = random.Random(seed)
    n_a, n_b = [(40, 40), (80, 15), (5, 100), (60, 0)][seed]
    a, b = table(spark, rng, n_a, "femaID", 5), table(spark, rng, n_b, "emdatID", 5)
    carry = (("n_femaID",), ("n_emdatID",))
    got = sp.event_map(a, b, a_carry=carry[0], b_carry=carry[1], spans=SPAN)
    by_days = sp.event_map(sp.expand_days(a), sp.expand_days(b), a_carry=carry[0], b_carry=carry[1])
    assert got.columns == by_days.columns
    assert sorted_rows(got, "n_femaID", "n_emdatID") == sorted_rows(by_days, "n_femaID", "n_emdatID") and got.count()


def test_query_sends_either_side_once_and_as_spans(spark):
    from eventweave.plans.q_spans import event_map_rows

    plan = event_map_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # pieces of spans are matched in one inner join; no second join deals the days of either side out again
    assert "LeftAnti" not in plan and "LeftOuter" not in plan and plan.count("__b___mask") > 0


def day_tables(a, b):
    em = sp.event_map(sp.expand_days(a), sp.expand_days(b))
    return ky.fill_updown(em, "femaID", "emdatID", ["Day", "emdatID asc nulls last"], fill_null_key=False)


@pytest.mark.parametrize("seed", range(4))
def test_filled_event_map_is_that_of_the_day_tables(spark, seed):
    rng = random.Random(seed)
    n_a, n_b = [(40, 40), (60, 12), (8, 100), (60, 0)][seed]
    a, b = table(spark, rng, n_a, "femaID", 8), table(spark, rng, n_b, "emdatID", 5)
    if seed == 1:  # ids of several spans and places
        a = a.withColumn("femaID", F.concat(F.lit("D"), (F.col("n_femaID") % 9).cast("string")))
    got, expected = sorted_rows(ky.filled_event_map(a, b)), sorted_rows(day_tables(a, b))
    assert got == expected and got


def test_filling_writes_no_pairs(spark, monkeypatch):
    day = lambda i: dt.date(2001, 1, 1) + dt.timedelta(i)
    a = spark.createDataFrame([(f"D_{i}", "TX", "x", day(0), day(3)) for i in range(30)], "femaID string, state string, county string, begin_date date, end_date date")
    b = spark.createDataFrame([(f"E{i:02d}", "TX", "x", day(1), day(2)) for i in range(40)], "emdatID string, state string, county string, begin_date date, end_date date")
    written = []

    def counted(df, name, *rest):
        written.append((name, df.count()))
        return materialize(df, name, *rest)

    monkeypatch.setattr(ky, "materialize", counted)
    monkeypatch.setattr(ordered, "materialize", counted)
    got = ky.filled_event_map(a, b).collect()
    # 2 days of 30 x 40 pairs, and the first and last day of 30 spans, filled with the next and the last id
    assert len(got) == 2460 and {(r.Day, r.emdatID) for r in got if r.Day in (day(0), day(3))} == {(day(0), "E00"), (day(3), "E39")}
    assert written and max(n for _, n in written) <= 30 * 4 * 2
