"""As-of attach against a plain search, design-based errors against their definition."""

import datetime as dt
import math
import random

import pytest

from eventweave.operators import spans as sp
from eventweave.operators import survey as sv

DAY0 = dt.date(2000, 1, 1)
day = lambda i: None if i is None else DAY0 + dt.timedelta(i)


@pytest.mark.parametrize("partitions", [None, 11])
@pytest.mark.parametrize("forward", [False, True])
def test_latest_event_matches_a_plain_search(spark, forward, partitions):
    rng = random.Random(partitions or 0)
    place = lambda: ("HOT", "x") if rng.random() < 0.5 else (rng.choice(["A", "B", None]), rng.choice(["x", "y", None]))
    panel = [(i, *place(), rng.choice([None, *range(60)])) for i in range(300)]
    panel += panel[:10]
    events = [(i, *place(), rng.choice([None, *range(-5, 70)])) for i in range(120)] + [(None, "HOT", "x", 3)]
    p = spark.createDataFrame([(i, s, c, day(d)) for i, s, c, d in panel], "pid int, state string, county string, day date").repartition(3)
    e = spark.createDataFrame([(i, s, c, day(d)) for i, s, c, d in events], "eid int, state string, county string, on date")
    for limit in (None, 2):
        got = sorted(map(str, sp.attach_latest(p, e, ["state", "county"], "day", "on", "eid", forward=forward, within_days=limit, partitions=partitions).collect()))
        plain = []
        for i, s, c, d in panel:
            fits = [
                (-f if forward else f, k) for k, es, ec, f in events
                if None not in (k, es, ec, f, s, c, d) and (es, ec) == (s, c) and (f >= d if forward else f <= d)
            ]
            best = max(fits) if fits else None
            f = None if best is None else abs(best[0]) if forward else best[0]
            if best is None or (limit is not None and abs(f - d) > limit):
                best, f = (None, None), None
            plain.append((i, s, c, day(d), day(f), best[1]))
        rows = spark.createDataFrame(plain, "pid int, state string, county string, day date, on date, eid int").collect()
        assert got == sorted(map(str, rows))


def test_asof_plan_and_edges(spark):
    p = spark.createDataFrame([(1, "A", DAY0)], "pid int, state string, day date")
    e = spark.createDataFrame([(7, "A", DAY0), (8, "A", DAY0)], "eid int, state string, on date")
    out = sp.attach_latest(p, e, ["state"], "day", "on", "eid")
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r.eid for r in out.collect()] == [8]
    assert [r.eid for r in sp.attach_latest(p, e.limit(0), ["state"], "day", "on", "eid").collect()] == [None]
    assert sp.attach_latest(p.limit(0), e, ["state"], "day", "on", "eid").count() == 0
    with pytest.raises(ValueError):
        sp.attach_latest(p, e.withColumnRenamed("eid", "pid"), ["state"], "day", "on", "pid")


def plain_design(rows, domain):
    """(n, total, se, mean, se) of (stratum, psu, weight, domain, y) rows, by the definition."""
    design = {}
    for h, j, w, _, _ in rows:
        if None not in (h, j, w):
            design.setdefault(h, set()).add(j)
    part = [(h, j, w, y) for h, j, w, d, y in rows if None not in (h, j, w, y) and d == domain]
    W, Y = sum(w for _, _, w, _ in part), sum(w * y for _, _, w, y in part)
    out = [len(part)]
    for estimate, value in ((Y, lambda w, y: w * y), (Y / W, lambda w, y: w * (y - Y / W) / W)):
        u = {(h, j): 0.0 for h, js in design.items() for j in js}
        for h, j, w, y in part:
            u[h, j] += value(w, y)
        overall = sum(u.values()) / len(u)
        v = 0.0
        for h, js in design.items():
            totals = [u[h, j] for j in js]
            if len(totals) == 1:
                v += (totals[0] - overall) ** 2
            else:
                mean = sum(totals) / len(totals)
                v += len(totals) / (len(totals) - 1) * sum((t - mean) ** 2 for t in totals)
        out += [estimate, math.sqrt(v)]
    return out


def test_design_errors_with_lonely_psus_and_empty_domains(spark):
    rng = random.Random(8)
    rows = []
    for h, psus in (("s1", 4), ("s2", 2), ("lonely", 1), ("elsewhere", 1), ("s3", 3)):
        for j in range(psus):  # ids are nested: every stratum has a PSU 0
            for _ in range(rng.randint(1, 12)):
                d = "b" if h == "elsewhere" else rng.choice(["a", "b", None])
                rows.append((h, j, round(rng.uniform(0.5, 3), 3), d, rng.choice([0, 1, 1, None])))
    rows += [("s1", None, 1.0, "a", 1), (None, 1, 1.0, "a", 1), ("s1", 9, None, "a", 1), ("s2", 7, 2.0, "a", None)]
    df = spark.createDataFrame(rows, "stratum string, PSU int, weight double, d string, y int")
    got = {r.d: (r.n, r.total, r.se_total, r.mean, r.se_mean) for r in sv.design_estimates(df, ["d"], "y").collect()}
    assert set(got) == {"a", "b", None}
    for d, found in got.items():
        assert found == pytest.approx(plain_design(rows, d), rel=1e-9)
    (r,) = sv.design_estimates(df, [], "y").collect()
    everyone = [(h, j, w, 1, y) for h, j, w, _, y in rows]
    assert tuple(r) == pytest.approx(plain_design(everyone, 1), rel=1e-9)
    assert sv.design_estimates(df.limit(0), ["d"], "y").count() == 0


def test_simple_random_sample_gives_the_textbook_error(spark):
    y = [1, 0, 1, 1, 0, 1, 0, 0, 1, 1]
    df = spark.createDataFrame([("s", i, 2.0, v) for i, v in enumerate(y)], "stratum string, PSU int, weight double, y int")
    (r,) = sv.design_estimates(df, [], "y").collect()
    mean = sum(y) / 10
    assert r["mean"] == mean and r["se_mean"] == pytest.approx(math.sqrt(mean * (1 - mean) / 9))
