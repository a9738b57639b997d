"""Pairs of busy places: the join forms the rows of the result and no others."""

import datetime as dt
import random

import pytest

from eventweave.operators import spans as sp

DAY0 = dt.date(1999, 12, 25)


def sides(spark, seed):
    rng = random.Random(seed)

    def rows(n):
        out = []
        for i in range(n):
            b = None if rng.random() < 0.05 else DAY0 + dt.timedelta(rng.randrange(40))
            length = rng.choice([-2, 0, 0, 1, 3, 6, 45, None])
            out.append((i % 30, rng.choice(["TX", "OK", None]), rng.choice(["x", "y", None]), b, None if b is None or length is None else b + dt.timedelta(length)))
        return out

    a, b = rows(60), rows(60)
    frame = lambda x, s: spark.createDataFrame(x, f"{s}_id int, state string, county string, {s}_begin date, {s}_end date")
    return a, b, frame(a, "a"), frame(b, "b")


def overlaps(a, b, null_safe):
    for x in a:
        for y in b:
            if None in (x[1], y[1], x[3], x[4], y[3], y[4]) or x[1] != y[1] or x[2] != y[2] or (x[2] is None and not null_safe):
                continue
            first, last = max(x[3], y[3]), min(x[4], y[4])
            if first <= last and x[3] <= x[4] and y[3] <= y[4]:
                yield x, y, first, last


@pytest.mark.parametrize("null_safe", [False, True])
def test_pairs_by_day_are_all_overlaps_once(spark, null_safe):
    a, b, A, B = sides(spark, 5)
    names = dict(a_begin="a_begin", a_end="a_end", b_begin="b_begin", b_end="b_end", null_safe_keys=["county"] if null_safe else None)
    m = sp.match_spans(A, B, ["state", "county"], bucket="day", **names)
    got = sorted(map(tuple, m.select("a_id", "b_id", "overlap_begin", "overlap_end", "overlap_days").collect()))
    pairs = list(overlaps(a, b, null_safe))
    assert got == sorted((x[0], y[0], f, t, (t - f).days + 1) for x, y, f, t in pairs) and got
    for text in (False, True):
        d = sp.match_days(A, B, ["state", "county"], text=text, **names).select("Day", "state", "county", "a_id", "b_id")
        days = [(f + dt.timedelta(i), x[1], x[2], x[0], y[0]) for x, y, f, t in pairs for i in range((t - f).days + 1)]
        expected = [(str(r[0]) if text else r[0], *r[1:]) for r in days]
        assert sorted(map(str, map(tuple, d.collect()))) == sorted(map(str, expected))


def test_nothing_is_tested_or_exploded_on_pairs(spark):
    *_, A, B = sides(spark, 6)
    names = dict(a_begin="a_begin", a_end="a_end", b_begin="b_begin", b_end="b_end")
    for m in (sp.match_spans(A, B, ["state"], bucket="day", **names), sp.match_days(A.drop("county"), B.drop("county"), ["state"], **names)):
        plan = m._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("Join Inner", 1)
        assert "Generate" not in above and "Filter" not in above
        condition = below.split("\n", 1)[0]
        assert ">=" not in condition and "<=" not in condition
