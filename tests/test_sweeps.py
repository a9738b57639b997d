"""Merged spans and concurrency against day rows; hot places cross many ranges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventweave.operators import spans as sp

SCHEMA = "place string, county string, begin_date date, end_date date"
DAY0 = dt.date(2000, 1, 1)


def spans(seed, n=400, hot=0.6):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        b = rng.randrange(900 if rng.random() < 0.8 else 60)
        length = rng.choice([-2, 0, 0, 1, 2, 5, 40])
        place, county = ("HOT", None) if rng.random() < hot else (rng.choice(["A", "B", None]), rng.choice(["x", None]))
        rows.append((place, county, DAY0 + dt.timedelta(b), None if rng.random() < 0.05 else DAY0 + dt.timedelta(b + length)))
    return rows


def plain_days(rows):
    days = {}
    for place, county, b, e in rows:
        while e is not None and b <= e:
            days.setdefault((place, county), {}).setdefault(b, 0)
            days[place, county][b] += 1
            b += dt.timedelta(1)
    return days


def plain_runs(days, by_level):
    out = []
    for key, counts in days.items():
        run = None
        for d in sorted(counts):
            n = counts[d] if by_level else 1
            if run and run[1] + dt.timedelta(1) == d and run[2] == n:
                run[1] = d
            else:
                run = [d, d, n]
                out.append((key, run))
    return sorted(((str(k), b, e, n) for k, (b, e, n) in out))


@pytest.mark.parametrize("partitions", [None, 1, 13])
@pytest.mark.parametrize("seed", [1, 2])
def test_sweeps_match_day_rows(spark, seed, partitions):
    rows = spans(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    keys = ["place", "county"]
    merged = sp.merge_spans(df, keys, partitions=partitions)
    assert sorted((str((r[0], r[1])), r[2], r[3], 1) for r in merged.collect()) == plain_runs(plain_days(rows), False)
    days = sp.collapse_days(sp.expand_days(df), keys)
    assert merged.select(*days.columns).exceptAll(days).count() == 0 and merged.count() == days.count()
    found = sp.concurrency(df, keys, partitions=partitions)
    assert sorted((str((r[0], r[1])), r[2], r[3], r[4]) for r in found.collect()) == plain_runs(plain_days(rows), True)
    for r in sp.peaks(found, keys).collect():
        counts = plain_days(rows)[r["place"], r["county"]]
        top = max(counts.values())
        assert (r["peak_open"], r["peak_days"]) == (top, sum(n == top for n in counts.values()))
        assert r["peak_begin"] == min(d for d, n in counts.items() if n == top)
        assert (r["days_open"], r["span_days"]) == (len(counts), sum(counts.values()))


def test_a_long_span_reaches_over_many_ranges(spark):
    rows = [("P", None, DAY0, DAY0 + dt.timedelta(5000))] + [("P", None, DAY0 + dt.timedelta(i), DAY0 + dt.timedelta(i)) for i in range(0, 4000, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    (r,) = sp.merge_spans(df, ["place"], partitions=16).collect()
    assert (r["begin_date"], r["end_date"], r["n_days"]) == (DAY0, DAY0 + dt.timedelta(5000), 5001)
    levels = sp.concurrency(df, ["place"], partitions=16)
    assert levels.count() == 4000 and levels.agg(F.sum(F.datediff("end_date", "begin_date") + 1)).first()[0] == 5001


def test_adjacent_spans_merge_and_cancelling_borders_vanish(spark):
    day = lambda i: DAY0 + dt.timedelta(i)
    df = spark.createDataFrame([("P", None, day(0), day(4)), ("P", None, day(5), day(9)), ("P", None, day(11), day(11))], SCHEMA)
    assert [(r["begin_date"], r["end_date"]) for r in sp.merge_spans(df, ["place"]).orderBy("begin_date").collect()] == [(day(0), day(9)), (day(11), day(11))]
    assert [(r["begin_date"], r["end_date"], r["n_open"]) for r in sp.concurrency(df, ["place"]).orderBy("begin_date").collect()] == [
        (day(0), day(9), 1), (day(11), day(11), 1)
    ]
    none = df.limit(0)
    assert sp.merge_spans(none, ["place"]).count() == sp.concurrency(none, ["place"]).count() == 0


def test_no_day_rows_in_the_plans(spark):
    df = spark.createDataFrame(spans(3), SCHEMA)
    for out in (sp.merge_spans(df, ["place"]), sp.concurrency(df, ["place"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "sequence" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert "explode" not in sp.merge_spans(df, ["place"])._jdf.queryExecution().executedPlan().toString().lower()
