"""Hard negatives against brute force; the index prunes where vectors cluster."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from eventweave.llm import hard_negatives as hn
from eventweave.llm.shipping import ship
from tests.conftest import SF001, SF01
from tests.oracle_check import compare, duck

SCHEMA = "vec_id long, label int, vec array<long>"
def anchor():
    return F.col("vec_id") % 100 == 0



def brute(rows, positives=5, negatives=10):
    """Sorted result rows of (vec_id, label, vector) rows, in whole numbers."""
    out = []
    for a, label, v in rows:
        if a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=False)), i, other) for i, other, w in rows if i != a]
        same = sorted(s for s in scored if s[2] == label)[:positives]
        others = sorted(s for s in scored if s[2] != label)
        for p in same:
            window = [n for n in others if 30 * -p[0] <= 100 * -n[0] <= 90 * -p[0]][:negatives]
            out += [(a, p[1], k + 1, n[1], -p[0], -n[0]) for k, n in enumerate(window)]
    return sorted(out)


def mined(frame, **how):
    return sorted(tuple(r) for r in hn.mine(frame, anchor(), **how).collect())


def vectors(n, dims, groups, spread, seed, hot=0.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dims))
    at = rng.integers(0, groups, n)
    at[: int(hot * n)] = 0
    x = centre[at] + spread * rng.normal(size=(n, dims))
    x[: int(hot * n) // 2] = centre[0]  # exact copies
    q = np.floor(64 * x / np.linalg.norm(x, axis=1, keepdims=True)).astype(int)
    label = np.where(rng.random(n) < 0.7, at % 10, rng.integers(0, 10, n))
    return [(i, int(lb), v) for i, (lb, v) in enumerate(zip(label.tolist(), q.tolist(), strict=True))]


@pytest.mark.parametrize(("dims", "groups", "spread", "hot"), [(16, 12, 0.2, 0.0), (15, 1, 1.0, 0.0), (8, 6, 0.4, 0.4), (2, 3, 0.5, 0.0)])
def test_results_equal_brute_force(spark, monkeypatch, dims, groups, spread, hot):
    monkeypatch.setattr(hn, "LEAST_BLOCK", 64)  # many blocks, salted cells
    rows = vectors(1500, dims, groups, spread, dims, hot)
    frame = ship(spark).createDataFrame(rows, SCHEMA).repartition(4)
    trace = []
    got = mined(frame, trace=trace)
    assert got == brute(rows) and got
    index = trace[0]
    sizes = [r["count"] for r in index.table.groupBy("block").count().collect()]
    assert max(sizes) <= 2 * 64 + 40 and len(sizes) >= 15  # a hot vector doesn't make a hot block


def test_clustered_vectors_are_pruned(spark):
    rows = vectors(6000, 32, 30, 0.1, 3)
    trace = []
    got = mined(ship(spark).createDataFrame(rows, SCHEMA), trace=trace)
    made, exact = hn.inner_products(trace)
    assert made < 0.6 * exact
    some = {a for a, *_ in got[:50]}
    assert [g for g in got if g[0] in some] == [b for b in brute([r for r in rows if r[0] % 100 or r[0] in some]) if b[0] in some]


def test_bounds_hold_for_every_row(spark):
    rows = vectors(800, 10, 5, 0.5, 9)
    index = hn.build_index(ship(spark).createDataFrame(rows, SCHEMA), anchor())
    table = index.table.toPandas()
    x = np.array(table["vec"].tolist(), dtype=float)
    for a in x[:40]:
        score, seen, previous = x @ a, set(), np.inf
        for half, high, low, cell in index.cells.visits(a):
            s = score[(table["cell"] == cell).to_numpy()]
            assert low <= s.min() and s.max() <= high <= half + 1e-3 and half <= previous
            previous = half
            seen.add(cell)
        assert seen == set(table["cell"])


def test_ties_nulls_odd_lengths_and_other_columns(spark):
    rows = [(i, i % 2, [1, 0, 0]) for i in range(0, 300)]  # one score for all: windows shut
    rows += [(300 + i, i % 3, [2, 1]) for i in range(30)] + [(400, 1, []), (401, 1, [5] * 5), (500, 0, [-1, -1]), (302, 0, [1, 1, 1])]
    rows.append(rows[5])  # a repeated row
    given = [(i, lb, v, 0, "x", 7) for i, lb, v in rows]
    given += [(None, 1, [1], 0, "x", 7), (600, None, [1], 0, "x", 7), (601, 1, None, 0, "x", 7)]
    frame = ship(spark).createDataFrame(given, f"{SCHEMA}, no long, block string, cell int")
    assert mined(frame) == brute(rows)
    assert hn.mine(frame.limit(0), anchor()).count() == 0
    assert mined(frame.filter("vec_id = 400")) == []
    huge = [(0, 0, [1 << 62]), (1, 0, [1 << 61]), (2, 1, [1 << 20])]
    assert mined(spark.createDataFrame(huge, SCHEMA)) == []


def test_rows_with_bad_components_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, None]), (2, [nan]), (3, [-inf, 1.0]), (4, None), (5, [0.1, -0.1]), (6, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1))
    used = frame.filter(hn.usable(F.col("label"), F.col("embedding")))
    got = {r["vec_id"]: r["v"] for r in used.select("vec_id", hn.whole_components(F.col("embedding"), 256.0).alias("v")).collect()}
    assert got == {5: [25, -26], 6: []}


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_query_equals_its_sql(spark, sf):
    name = "op13_hard_negatives"
    info = compare(spark, duck(sf), sf, name, entry.queries()[name], entry.oracle_sql()[name])
    assert info["ok"], info
