"""Approximate nearest neighbours on shifted Hilbert curves (operator 6).

Vectors are projected onto ``CURVES`` random orthogonal frames of ``DIMS`` directions,
each with a random shift, and ordered along a Hilbert curve in each.  Every ordering is
cut into ``CELLS`` ranges of equal numbers of vectors; a query meets the vectors of its
own range and of the ``REACH`` neighbouring ranges on either side, in every ordering.  The
candidates of all windows merge and are ranked by the exact inner product.

Largest inner product becomes nearest neighbour by one more coordinate that lifts all
vectors to the largest norm (queries, scaled to that norm, have none).  Windows are
shares of the table, so recall doesn't fall as it grows; wide ranges are cut into blocks
of ``BLOCK`` rows for candidates and queries, and every pair of blocks is one task's
matrix product.  Equal vectors are one point of the index and carry their smallest
ids, as many as a result can show.

Edge cases: a vector that is null, zero, holds a null or non-finite component, or has
not the most frequent number of components takes no part, nor does a row with a null
id; ties go to the smaller id; repeated rows (same id and vector) count
once; fewer candidates than ``k`` give all; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

NEIGHBOURS = 20
CURVES = 24
DIMS = 6
LEVELS = 5
CELLS = 64
REACH = 1
BLOCK = 32_768
QUERY_BLOCK = 8_192
SEED = 20240601


# ------------------------------------------------------------------ inside a task


def hilbert_keys(x: np.ndarray, levels: int) -> np.ndarray:
    """Position along the Hilbert curve of integer points ``x`` (n, dims) in [0, 2^levels)."""
    axis = [np.ascontiguousarray(c).astype(np.int64) for c in x.T]
    side = 1 << (levels - 1)
    while side > 1:  # undo the rotation of each sub-cube, coarse to fine
        low = side - 1
        for i in range(len(axis)):
            far = (axis[i] & side) != 0
            swap = np.where(far, 0, (axis[0] ^ axis[i]) & low)
            axis[0] = np.where(far, axis[0] ^ low, axis[0]) ^ swap
            axis[i] = axis[i] ^ swap
        side >>= 1
    for i in range(1, len(axis)):
        axis[i] = axis[i] ^ axis[i - 1]
    turn, side = np.zeros_like(axis[0]), 1 << (levels - 1)
    while side > 1:
        turn = np.where((axis[-1] & side) != 0, turn ^ (side - 1), turn)
        side >>= 1
    key = np.zeros(len(x), dtype=np.int64)
    for level in range(levels - 1, -1, -1):
        for a in axis:
            key = (key << 1) | (((a ^ turn) >> level) & 1)
    return key


class Frames:
    """The random frames and shifts, fitted to the table's mean, spread and largest norm."""

    def __init__(self, mean: np.ndarray, cov: np.ndarray, norm: float, curves: int, dims: int, levels: int, seed: int):
        d = len(mean)
        dims = min(dims, d + 1)
        rng = np.random.default_rng(seed)
        self.levels, self.norm, self.frames = levels, norm, []
        for _ in range(curves):
            q, _ = np.linalg.qr(rng.normal(size=(d + 1, dims)))
            spread = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", q[:d], cov, q[:d]), 1e-24))
            self.frames.append((q, mean @ q[:d], spread, rng.random(dims)))

    def keys(self, v: np.ndarray, lift: np.ndarray) -> np.ndarray:
        """(rows, curves) Hilbert keys of ``v`` with the extra coordinate ``lift``."""
        out = np.empty((len(v), len(self.frames)), dtype=np.int64)
        for c, (q, centre, spread, shift) in enumerate(self.frames):
            z = (v @ q[:-1] + lift[:, None] * q[-1] - centre) / spread
            even = 1 / (1 + np.exp(-1.702 * np.clip(z, -20, 20)))  # about uniform for bell-shaped coordinates
            grid = ((even + shift) * (1 << (self.levels - 1))).astype(np.int64)
            out[:, c] = hilbert_keys(np.minimum(grid, (1 << self.levels) - 1), self.levels)
        return out

    def both(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of vectors as candidates and as queries."""
        size = np.sqrt((v * v).sum(axis=1))
        lift = np.sqrt(np.maximum(self.norm**2 - size**2, 0.0))
        return self.keys(v, lift), self.keys(v * (self.norm / size)[:, None], np.zeros(len(v)))


def _vectors(raw: pa.Array, dims: int) -> np.ndarray:
    if not len(raw):
        return np.empty((0, dims))
    return np.frombuffer(b"".join(raw.to_pylist()), dtype=np.float64).reshape(len(raw), dims)


def nearest_in_block(q: np.ndarray, c: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score) of each query's ``k`` best: chosen by a matrix
    product, then scored row by row, so a pair's score doesn't depend on its block."""
    rows, cols, scores = [], [], []
    step = max(1, (4 << 20) // max(1, len(c)))
    for first in range(0, len(q), step):
        s = q[first : first + step] @ c.T
        if len(c) > k:
            floor = np.partition(s, len(c) - k, axis=1)[:, len(c) - k]
            r, j = np.nonzero(s >= (floor - 1e-9 * np.maximum(1.0, np.abs(floor)))[:, None])
        else:
            r, j = np.nonzero(np.ones_like(s, dtype=bool))
        exact = (q[first + r] * c[j]).sum(axis=1)
        order = np.lexsort((ids[j], -exact, r))
        r, j, exact = r[order], j[order], exact[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        rows.append(first + r[rank < k])
        cols.append(j[rank < k])
        scores.append(exact[rank < k])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(scores)


# -------------------------------------------------------------------- distributed


def _clean(table: DataFrame, keep: int, query: Column) -> tuple[DataFrame, int]:
    """(vector, ids, asked): distinct usable vectors as float64 bytes, their ``keep`` smallest
    ids, and whether a query has that vector.  Each task first merges its own rows."""
    given = table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).withColumn("asked", query)
    common = given.groupBy(F.size("embedding").alias("n")).agg(F.count(F.lit(1)).alias("rows")).filter("n > 0")
    row = common.orderBy(F.col("rows").desc(), "n").first()
    dims = row["n"] if row else 0
    whole = F.size("embedding") == dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list] = {}
            flat = batch.column("embedding").flatten().cast(pa.float64())
            v = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dims) + 0.0
            ok = np.isfinite(v).all(axis=1) & (v != 0).any(axis=1)
            asked = batch.column("asked").to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(ok).tolist():
                found.setdefault(v[i].tobytes(), []).append((batch.column("vec_id")[i].as_py(), bool(asked[i])))
            if found:
                ids = [sorted({i for i, _ in x})[:keep] for x in found.values()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.binary()), pa.array(ids, pa.list_(pa.int64())), pa.array([any(a for _, a in x) for x in found.values()])],
                    ["vector", "ids", "asked"],
                )

    merged = given.filter(whole).select("vec_id", "embedding", "asked").mapInArrow(run, "vector binary, ids array<long>, asked boolean")
    smallest = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return materialize(merged.groupBy("vector").agg(smallest.alias("ids"), F.max("asked").alias("asked")), "ann_points"), dims


def _moments(points: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray, float]:
    """Number, mean, covariance and largest norm of the points (dims^2 numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square, top = 0, np.zeros(dims), np.zeros((dims, dims)), 0.0
        for batch in batches:
            v = _vectors(batch.column("vector"), dims)
            if len(v):
                n, total, square = n + len(v), total + v.sum(0), square + v.T @ v
                top = max(top, float((v * v).sum(axis=1).max()))
        flat = np.concatenate([[n], total, square.ravel()])
        kind = ["sum"] * len(flat) + ["max"]
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(np.append(np.arange(len(flat)), 0)), pa.array(np.append(flat, top))], ["kind", "i", "x"])

    parts = points.select("vector").mapInArrow(run, "kind string, i long, x double").groupBy("kind", "i").agg(F.sum("x").alias("s"), F.max("x").alias("m"))
    got = {(r["kind"], r["i"]): r for r in parts.collect()}
    if not got or got["sum", 0]["s"] == 0:
        return 0, np.zeros(dims), np.zeros((dims, dims)), 0.0
    flat = np.array([got["sum", i]["s"] for i in range(1 + dims + dims * dims)])
    n, mean = flat[0], flat[1 : 1 + dims] / flat[0]
    return int(n), mean, flat[1 + dims :].reshape(dims, dims) / n - np.outer(mean, mean), float(np.sqrt(got["max", 0]["m"]))


def search(
    table: DataFrame,
    query: Column,
    k: int = NEIGHBOURS,
    curves: int = CURVES,
    dims: int = DIMS,
    levels: int = LEVELS,
    cells: int = CELLS,
    reach: int = REACH,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found to each row of ``table`` (vec_id,
    embedding) for which ``query`` holds, itself left out, by largest inner product."""
    spark = table.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    points, size = _clean(table, k + 1, query)
    n, mean, cov, norm = _moments(points, size) if size else (0, None, None, 0.0)
    if not n:
        return spark.createDataFrame([], schema)
    frames = Frames(mean, cov, norm, curves, dims, levels, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, asking = frames.both(_vectors(batch.column("vector"), size))
            keys = [pa.array(x.tolist(), pa.list_(pa.int64())) for x in (own, asking)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *keys], ["vector", "rep", "asked", "own", "asking"])

    placed = points.select("vector", F.element_at("ids", 1).alias("rep"), "asked").mapInArrow(
        run, "vector binary, rep long, asked boolean, own array<long>, asking array<long>"
    )
    placed = materialize(placed, "ann_keys")
    # range borders of every ordering: cells - 1 numbers a curve; a range has room for several results
    cells = max(1, min(cells, n // (4 * (k + 1))))
    shares = [i / cells for i in range(1, cells)]
    borders = {c: [] for c in range(curves)}
    if shares:
        ordered = placed.select(F.posexplode("own").alias("curve", "key")).groupBy("curve").agg(F.percentile_approx("key", shares, 10_000).alias("borders"))
        borders = {r["curve"]: r["borders"] for r in ordered.collect()}
    table_of = F.array(*[F.array(*[F.lit(b) for b in borders[c]]).cast("array<bigint>") for c in range(curves)])
    cell = lambda key: F.aggregate(F.get(table_of, F.col("curve")), F.lit(0), lambda a, b: a + (b <= key).cast("int"))
    blocks, query_blocks = max(1, round(n / cells / BLOCK + 0.5)), max(1, round(n / cells / QUERY_BLOCK + 0.5))
    cands = placed.select("vector", "rep", F.posexplode("own").alias("curve", "key")).withColumn("cell", cell(F.col("key")))
    cands = cands.withColumn("b", F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int"))
    cands = cands.select("curve", "cell", "b", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"), F.lit(False).alias("asks"), "rep", "vector")
    asks = placed.filter("asked").select("vector", "rep", F.posexplode("asking").alias("curve", "key")).withColumn("home", cell(F.col("key")))
    asks = asks.withColumn("qb", F.pmod(F.xxhash64("rep"), F.lit(query_blocks)).cast("int"))
    asks = asks.withColumn("cell", F.explode(F.sequence(F.greatest(F.lit(0), F.col("home") - reach), F.least(F.lit(cells - 1), F.col("home") + reach))))
    asks = asks.select("curve", "cell", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), "qb", F.lit(True).alias("asks"), "rep", "vector")

    def block(rows: pa.Table) -> pa.Table:
        side = rows.column("asks").combine_chunks().to_numpy(zero_copy_only=False)
        rep = rows.column("rep").combine_chunks().to_numpy()
        v = _vectors(rows.column("vector").combine_chunks(), size)
        if side.all() or not side.any():
            empty = np.empty(0)
            return pa.table({"query": pa.array(empty, pa.int64()), "cand": pa.array(empty, pa.int64()), "score": pa.array(empty, pa.float64())})
        i, j, s = nearest_in_block(v[side], v[~side], rep[~side], k + 1)
        return pa.table({"query": rep[side][i], "cand": rep[~side][j], "score": s})

    def ranked(met: DataFrame) -> DataFrame:
        """The best of each query over all blocks that met it."""
        found = met.groupBy("curve", "cell", "b", "qb").applyInArrow(block, "query long, cand long, score double")
        best = Window.partitionBy("query").orderBy(F.col("score").desc(), "cand")
        found = found.groupBy("query", "cand").agg(F.max("score").alias("score"))
        return materialize(found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n"), "ann_merged")

    merged = ranked(cands.unionByName(asks))
    # queries that fell beside the table's ranges and met too few points: against all, in blocks
    met = merged.groupBy(F.col("query").alias("rep")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min(k + 1, n))
    few = materialize(placed.filter("asked").select("rep", "vector").join(met, "rep", "left_anti"), "ann_few")
    if few.limit(1).count():
        every = lambda t, asks: t.withColumns({"curve": F.lit(-1), "cell": F.lit(0), "qb": F.lit(0), "asks": F.lit(asks)})
        parts = max(1, -(-n // BLOCK))
        whole = every(placed.select("rep", "vector"), False).withColumn("b", F.pmod(F.xxhash64("rep"), F.lit(parts)).cast("int"))
        asking = every(few, True).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        rest = ranked(whole.unionByName(asking))
        merged = merged.join(few.select(F.col("rep").alias("query")), "query", "left_anti").unionByName(rest)
    # from points back to rows: a point's ids, then each query row without itself
    members = points.select(F.element_at("ids", 1).alias("cand"), "ids")
    entry = F.struct((-F.col("score")).alias("minus"), F.col("vec_id"))
    listed = merged.join(members, "cand").withColumn("vec_id", F.explode("ids")).groupBy("query").agg(
        F.slice(F.array_sort(F.collect_list(entry)), 1, k + 1).alias("entries")
    )
    listed = listed.join(points.select(F.element_at("ids", 1).alias("query"), "vector"), "query").select("vector", "entries")
    listed = materialize(listed, "ann_lists")

    def own_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("embedding").flatten().cast(pa.float64())
            v = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, size) + 0.0
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([x.tobytes() for x in v], pa.binary())], ["query_id", "vector"])

    rows = table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") == size)).filter(query)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(own_rows, "query_id long, vector binary")
    shown = F.slice(F.filter("entries", lambda e: e["vec_id"] != F.col("query_id")), 1, k)
    out = rows.join(listed, "vector").select("query_id", F.posexplode(shown).alias("pos", "e"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "e.vec_id", (-F.col("e.minus")).alias("score"))
