"""Minting without a join back (F3, F5, F7-F10): numbers of distinct ids on the rows that carry the full ids."""

from __future__ import annotations

from eventweave.operators import keys as ky
from eventweave.operators.ordered import add_offsets, number_flagged, range_offsets, ranged

IDS = "femaID string, emdatID string, smashedID string, state string, Day date"


def rows(spark):
    found = [(f"D{i}_{j:03d}", f"E{i % 7}", f"D{i}_E{i % 7}", "TX" if j else "LA", f"2001-0{1 + i % 3}-1{j}") for i in range(40) for j in range(3)]
    return spark.createDataFrame(found, IDS.replace("Day date", "d string")).selectExpr("femaID", "emdatID", "smashedID", "state", "cast(d AS date) AS Day")


def plain(found):
    start = {}
    for r in found:
        start[r.smashedID] = min(start.get(r.smashedID, r.Day), r.Day)
    pairs = sorted({(start[r.smashedID].strftime("%Y_%m"), r.state, r.smashedID) for r in found})
    numbers, key = {}, {}
    for ym, state, i in pairs:
        numbers[ym, state] = n = numbers.get((ym, state), 0) + 1
        key[i, state] = f"{ym}_{state}_{n:02d}"
    return {(r.femaID, r.emdatID, r.smashedID, r.state, key[r.smashedID, r.state]) for r in found}


def test_keys_of_grouped_ids_are_those_of_the_plain_rule(spark):
    df = rows(spark)
    for grouped in (False, True):
        got = ky.mint_keys(df, grouped=grouped)
        assert {tuple(r) for r in got.collect()} == plain(df.collect()) and got.count() == 120
    plan = ky.mint_keys(df, grouped=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan  # neither the ids nor the offsets are joined by another shuffle


def test_flagged_numbers_go_on_over_range_borders(spark):
    df = spark.range(1000).selectExpr("'k' AS k", "id DIV 4 AS v", "cast(id % 4 = 2 AS int) AS f")
    got = number_flagged(df, ["k"], ["v", "f desc"], "f")
    assert got.filter("rn <> v + 1").count() == 0 and got.count() == 1000
    t = ranged(df, ["k"], ["v", "f desc"], 5)
    off = range_offsets(t, ["k"])
    assert off.filter("__off > 0").groupBy("__range").count().filter("count > 1").count() == 0
    assert add_offsets(t.selectExpr("*", "1 AS n"), off, ["k"], "n", "n").count() == 1000
