"""Hard negatives by an inverted multi-index (operator 13).

Each half of a vector has a codebook; the pair of a row's codewords is its cell.  For an anchor a = (a1, a2) the
inner product with any row of cell (i, j) is at most a1.c1[i] + |a1| r1[i] + a2.c2[j] + |a2| r2[j], r being the largest
distance of a row's half from its codeword.  A heap over the two sorted lists of half bounds gives the
cells from the highest bound down (multi-sequence order); the radii of a cell's own rows then tighten its bound.

``mine`` takes, for every anchor, its nearest rows of the same label (positives) and, for each of them,
the highest-scoring rows of other labels inside the score window that the positive sets.  Either search has two rounds: the
first visits cells in heap order until they hold ``FIRST_SHARE`` of the rows; the scores found certify where
the second may stop, at the first cell whose bound lies below the last needed score (or below the
window; cells wholly above all windows are passed over).  What is left unvisited can't
hold an answer, so results are exact, ties included.

Distribution: codebooks are fitted on at most ``SAMPLE`` distinct vectors (a documented bound); all rows are
assigned.  The index is cut into blocks of neighbouring cells; a crowded cell is salted over several
blocks, so no block grows with a hot vector.  An anchor goes to each block that has a cell it wants; a
task holds one block and streams the anchors past it, multiplying in slices.  The driver holds codebooks, radii and
cell counts, ``CODEWORDS`` squared numbers at any size of the table.

Edge cases: rows with a null id, label or vector, or a null or non-finite component, take no part; a shorter
vector is filled up with zeros; components are rounded down to whole numbers and kept within the range in
which every inner product is exact in double precision; rows that repeat an id are rows of their own, and rows with
the anchor's id are not candidates; an anchor without positives or with empty windows gives no rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .sampling import distinct_sample

SAMPLE = 20_000
CODEWORDS = 32
FIT_ROUNDS = 8
FIRST_SHARE = 1 / 16
#: rows in a block of the index: at most this, and less in small tables to occupy the tasks
BLOCK = 65_536
LEAST_BLOCK = 1_024
BLOCKS = 64
#: scores held at once inside a task
SLICE = 1 << 21

LOW, HIGH = -(1 << 62), 1 << 62
_WANTED = "no long, vec_id long, label int, vec array<int>, spans array<struct<at:int,low:long,high:long,least:long>>, first_block int, n_blocks int, cells array<int>"
_FOUND = "no long, at int, vec_id long, score long"


def whole_components(embedding: Column, factor: float) -> Column:
    """floor(factor * x) of every component."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * factor))


def usable(label: Column, embedding: Column) -> Column:
    """Rows that take part: label, vector and all components present and finite."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return label.isNotNull() & embedding.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64) if dims else np.zeros((len(column), 0))


def _codebook(x: np.ndarray, words: int) -> np.ndarray:
    """Lloyd's algorithm from spread-out starts (each the point farthest from those before)."""
    x = np.unique(x, axis=0)
    centres = [x[0]]
    gap = ((x - x[0]) ** 2).sum(1)
    while len(centres) < min(words, len(x)) and gap.max() > 0:
        centres.append(x[int(gap.argmax())])
        gap = np.minimum(gap, ((x - centres[-1]) ** 2).sum(1))
    c = np.array(centres)
    for _ in range(FIT_ROUNDS):
        near = _nearest(x, c)[0]
        count = np.bincount(near, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], c)
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest codeword, distance from it) of every row."""
    near = ((c**2).sum(1) - 2 * (x @ c.T)).argmin(1) if c.shape[1] else np.zeros(len(x), dtype=np.int64)
    return near, np.sqrt(((x - c[near]) ** 2).sum(1))


@dataclass
class Cells:
    """What an anchor needs to know of the index: bounded by the codebooks, whatever the table."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray  # rows by cell number, i * words + j
    own_radii: tuple[np.ndarray, np.ndarray]  # by cell number: those of the cell's rows alone
    first_block: np.ndarray
    n_blocks: np.ndarray

    def visits(self, a: np.ndarray) -> Iterator[tuple[float, float, float, int]]:
        """(summed half bound, the cell's own upper and lower bound, cell) of the occupied cells, from the
        highest half bound down."""
        half = self.books[0].shape[1]
        upper, centres, norms = [], [], []
        for x, book, radius in zip((a[:half], a[half:]), self.books, self.radii, strict=True):
            centres.append(book @ x)
            norms.append(math.sqrt(float(x @ x)))
            upper.append(centres[-1] + norms[-1] * radius)
            upper[-1] += 1e-9 * (np.abs(centres[-1]) + norms[-1] * radius) + 1e-6  # for rounding
        order = [np.argsort(-u, kind="stable").tolist() for u in upper]
        u1, u2 = upper[0][order[0]].tolist(), upper[1][order[1]].tolist()
        words, counts = len(order[1]), self.counts
        centre = np.add.outer(*centres).ravel()
        slack = norms[0] * self.own_radii[0] + norms[1] * self.own_radii[1]
        slack += 1e-9 * (np.add.outer(*map(np.abs, centres)).ravel() + slack) + 1e-6
        high, low, counts = (centre + slack).tolist(), (centre - slack).tolist(), counts.tolist()
        heap, seen = [(-(u1[0] + u2[0]), 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = order[0][i] * words + order[1][j]
            if counts[cell]:
                yield -bound, high[cell], low[cell], cell
            for to in ((i + 1, j), (i, j + 1)):
                if to[0] < len(u1) and to[1] < len(u2) and to not in seen:
                    seen.add(to)
                    heapq.heappush(heap, (-(u1[to[0]] + u2[to[1]]), *to))

    def wanted(self, a: np.ndarray, low: int, high: int, first_rows: float, floor: int | None) -> list[int]:
        """Cells of a round: the first until they hold ``first_rows`` rows (``floor`` None), else those after
        them down to bound ``floor``.  Cells that can't hold a score in [low, high] are passed over."""
        out, rows = [], 0
        least = low if floor is None else max(low, floor)
        for bound, upper, lower, cell in self.visits(a):
            if bound < least:
                break
            if lower > high or upper < low:
                continue
            if rows < first_rows:
                if floor is None:
                    out.append(cell)
            elif floor is None:
                break
            elif upper >= floor:
                out.append(cell)
            rows += int(self.counts[cell])
        return out


@dataclass
class Index:
    table: DataFrame  # no, vec_id, label, vec, is_anchor, cell, block
    cells: Cells
    dims: int
    rows: int


def build_index(rows: DataFrame, anchors: Column) -> Index | None:
    """Index of ``rows(vec_id long, label int, vec array<long>)``; None without rows."""
    size = rows.agg(F.max(F.size("vec")), F.count(F.lit(1))).first()
    dims, n = size[0] or 0, size[1]
    if not n:
        return None
    limit = math.isqrt((1 << 53) // max(dims, 1))  # products of such components, summed, are exact
    clamped = F.transform("vec", lambda x: F.least(F.greatest(x, F.lit(-limit)), F.lit(limit)).cast("int"))
    filled = F.concat(clamped, F.array_repeat(F.lit(0), F.lit(dims) - F.size("vec")))
    rows = rows.select(F.col("vec_id"), F.col("label"), filled.alias("vec"), anchors.alias("is_anchor"))
    sample = distinct_sample(rows.select("vec"), SAMPLE, "codebook_sample").select("vec").toArrow()
    x, half = _matrix(sample.column("vec").combine_chunks(), dims), dims // 2
    books = (_codebook(x[:, :half], CODEWORDS), _codebook(x[:, half:], CODEWORDS))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("vec"), dims)
            (i, d1), (j, d2) = _nearest(v[:, :half], books[0]), _nearest(v[:, half:], books[1])
            made = [pa.array(i * len(books[1]) + j, pa.int32()), pa.array(d1), pa.array(d2)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "cell", "d1", "d2"])

    schema = "vec_id long, label int, vec array<int>, is_anchor boolean, cell int, d1 double, d2 double"
    placed = materialize(rows.mapInArrow(assign, schema).withColumn("no", F.monotonically_increasing_id()), "multi_index")
    words = len(books[1])
    found = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d1").alias("r1"), F.max("d2").alias("r2")).collect()  # CODEWORDS^2 rows at most
    counts = np.zeros(len(books[0]) * words, dtype=np.int64)
    own = (np.zeros(len(counts)), np.zeros(len(counts)))
    for r in found:
        counts[r["cell"]], own[0][r["cell"]], own[1][r["cell"]] = r["n"], r["r1"], r["r2"]
    radii = (own[0].reshape(-1, words).max(1), own[1].reshape(-1, words).max(0))
    block = min(BLOCK, max(LEAST_BLOCK, -(-n // BLOCKS)))
    first, number, at, held = np.zeros_like(counts), np.ones_like(counts), 0, 0
    for cell, c in enumerate(counts.tolist()):
        if held and held + c > block:
            at, held = at + 1, 0
        first[cell], number[cell] = at, max(1, -(-c // block))
        if number[cell] > 1:
            at, held = at + int(number[cell]), 0
        else:
            held += c
    cells = Cells(books, radii, counts, own, first, number)
    by_cell = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("cell") + 1)
    in_block = (by_cell(first) + F.pmod(F.xxhash64("no"), by_cell(number))).cast("int")
    return Index(placed.withColumn("block", in_block), cells, dims, n)


def _wanted(index: Index, anchors: DataFrame) -> DataFrame:
    """(anchor, block, cells) of ``anchors(no, vec_id, label, vec, spans, floor, has_floor)``."""
    cells, dims, first_rows = index.cells, index.dims, FIRST_SHARE * index.rows

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("vec"), dims)
            spans, floors = batch.column("spans").to_pylist(), batch.column("floor").to_pylist()
            row, first, number, lists = [], [], [], []
            for r, (span, floor) in enumerate(zip(spans, floors, strict=True)):
                low, high = min(s["low"] for s in span), max(s["high"] for s in span)
                by_block: dict[tuple[int, int], list[int]] = {}
                for cell in cells.wanted(v[r], low, high, first_rows, floor):
                    by_block.setdefault((int(cells.first_block[cell]), int(cells.n_blocks[cell])), []).append(cell)
                for (block, n), some in by_block.items():
                    row.append(r)
                    first.append(block)
                    number.append(n)
                    lists.append(some)
            kept = batch.select(["no", "vec_id", "label", "vec", "spans"]).take(pa.array(row, pa.int64()))
            made = [pa.array(first, pa.int32()), pa.array(number, pa.int32()), pa.array(lists, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*kept.columns, *made], names=[*kept.schema.names, "first_block", "n_blocks", "cells"])

    found = anchors.select("no", "vec_id", "label", "vec", "spans", "floor").mapInArrow(plan, _WANTED)
    return found.withColumn("block", F.explode(F.sequence("first_block", F.col("first_block") + F.col("n_blocks") - 1))).drop("first_block", "n_blocks")


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))][:k]


def _scan(dims: int, same_label: bool, k: int) -> Callable:
    """Stream anchors past the blocks of a partition sorted by (block, kind, cell, label)."""

    def block_of(batches: list[pa.RecordBatch]) -> tuple:
        t = pa.Table.from_batches(batches).combine_chunks()
        column = lambda name: t.column(name).combine_chunks()
        cell = column("cell").to_numpy(zero_copy_only=False).astype(np.int64)
        label, ids = column("label").to_numpy(zero_copy_only=False), column("vec_id").to_numpy(zero_copy_only=False)
        present, begin = np.unique(cell, return_index=True)
        return _matrix(column("vec"), dims), label, ids, present, [*begin.tolist(), len(cell)]

    def scores(block: tuple, a: np.ndarray, labels: np.ndarray, wants: list[list[int]]) -> np.ndarray:
        """Scores of the slice's anchors with the rows they visit; others are -inf."""
        members, label, _, present, begin = block
        out = np.full((len(a), len(members)), -np.inf)
        place = {c: p for p, c in enumerate(present.tolist())}
        visiting: list[list[int]] = [[] for _ in place]
        for r, some in enumerate(wants):
            for c in some:
                if c in place:  # a salted cell need not be in each of its blocks
                    visiting[place[c]].append(r)
        for p, rows in enumerate(visiting):
            if not rows:
                continue
            rows, z = np.array(rows), slice(begin[p], begin[p + 1])
            if not same_label:
                out[rows, z] = a[rows] @ members[z].T
                continue
            for one in np.unique(labels[rows]):  # a cell's rows are in label order
                y = slice(*(begin[p] + np.searchsorted(label[z], [one, one + 1])).tolist())
                some = rows[labels[rows] == one]
                out[some, y] = a[some] @ members[y].T
        return out

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, members, block = None, [], None
        for batch in batches:
            number, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "kind"))
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (kind[1:] != kind[:-1])) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(number)], strict=True):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if number[begin] != held:
                    held, members, block = number[begin], [], None
                if kind[begin] == 0:
                    members.append(part)
                    continue
                if not members:
                    continue
                block = block or block_of(members)
                step = max(1, SLICE // len(block[0]))
                for z in range(0, part.num_rows, step):
                    yield from visit(block, part.slice(z, step))

    def visit(block: tuple, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        labels = part.column("label").to_numpy(zero_copy_only=False)
        own, no = part.column("vec_id").to_numpy(zero_copy_only=False), part.column("no").to_pylist()
        found = scores(block, _matrix(part.column("vec"), dims), labels, part.column("cells").to_pylist())
        _, member_labels, ids, _, _ = block
        out: list[tuple] = []
        for r, span in enumerate(part.column("spans").to_pylist()):
            s = found[r]
            fits = (s > -np.inf) & (ids != own[r])
            if not same_label:
                fits &= member_labels != labels[r]
            for one in span:
                at = np.flatnonzero(fits & (s >= one["least"]) & (s <= one["high"]))
                at = at[_best(s[at], ids[at], k)]
                out.extend((no[r], one["at"], i, int(x)) for i, x in zip(ids[at].tolist(), s[at].tolist(), strict=True))
        if out:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["no", "at", "vec_id", "score"])

    return scan


def _search(index: Index, wanted: DataFrame, same_label: bool, k: int) -> DataFrame:
    """The best ``k`` rows of every (anchor, span) among the cells wanted, block by block."""
    null = F.lit(None)
    spans = "array<struct<at:int,low:long,high:long,least:long>>"
    rows = index.table.join(wanted.select("block").distinct(), "block", "left_semi")
    rows = rows.select("block", F.lit(0).alias("kind"), "cell", "no", "vec_id", "label", "vec", null.cast(spans).alias("spans"), null.cast("array<int>").alias("cells"))
    asked = wanted.select("block", F.lit(1).alias("kind"), F.lit(0).alias("cell"), "no", "vec_id", "label", "vec", "spans", "cells")
    dealt = rows.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind", "cell", "label")
    return dealt.mapInArrow(_scan(index.dims, same_label, k), _FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("no", "at").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _two_rounds(index: Index, anchors: DataFrame, same_label: bool, k: int, name: str, trace: list | None) -> DataFrame:
    """The exact best ``k`` of every span of ``anchors(no, vec_id, label, vec, spans)``: (no, at, vec_id, score, rank)."""
    unknown = F.lit(None).cast("long")
    started = anchors.withColumn("spans", F.transform("spans", lambda x: x.withField("least", x["low"]))).withColumn("floor", unknown)
    wanted = materialize(_wanted(index, started), f"{name}_first_cells")
    first = materialize(_top(_search(index, wanted, same_label, k), k).drop("rank"), f"{name}_first")
    # the last needed score of a span: lower ones are no answers; a span that isn't full yet needs all of its scores
    last = first.groupBy("no", "at").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("last"))
    spans = anchors.select("no", F.explode("spans").alias("span")).select("no", "span.at", "span.low", "span.high").join(last, ["no", "at"], "left")
    least = F.coalesce("last", "low").alias("least")
    known = spans.groupBy("no").agg(F.min(least).alias("floor"), F.array_sort(F.collect_list(F.struct("at", "low", "high", least))).alias("spans"))
    rest = materialize(_wanted(index, anchors.drop("spans").join(known, "no")), f"{name}_other_cells")
    if trace is not None:
        trace.extend([(name, same_label, wanted), (name, same_label, rest)])
    return materialize(_top(first.unionByName(_search(index, rest, same_label, k)), k), name)


def mine(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    trace: list | None = None,
) -> DataFrame:
    """Hard negatives of the anchors of ``rows(vec_id, label, vec)``, ``vec`` in whole numbers: for every anchor's
    nearest rows of its label, the highest-scoring rows of other labels whose score is between the two percentages of the
    positive's: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.  ``trace`` gathers the
    tables of visited cells."""
    spark = rows.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("int"), "vec").filter("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    index = build_index(rows, anchors)
    if index is None:
        return spark.createDataFrame([], result)
    if trace is not None:
        trace.append(index)
    asked = index.table.filter("is_anchor").select("no", "vec_id", "label", "vec")
    everything = F.array(F.struct(F.lit(0).alias("at"), F.lit(LOW).alias("low"), F.lit(HIGH).alias("high")))
    near = _two_rounds(index, asked.withColumn("spans", everything), True, positives, "positives", trace)
    # whole-number borders of low_percent * positive <= 100 * negative <= high_percent * positive
    low = F.ceil(F.col("score") * low_percent / F.lit(100).cast("decimal(38,0)")).cast("long")
    high = F.floor(F.col("score") * high_percent / F.lit(100).cast("decimal(38,0)")).cast("long")
    spans = near.withColumn("low", low).withColumn("high", high).filter("low <= high")
    spans = spans.groupBy("no").agg(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("at"), "low", "high"))).alias("spans"))  # positives at most
    found = _two_rounds(index, asked.join(spans, "no"), False, negatives, "negatives", trace)
    found = found.select("no", F.col("at").alias("p"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = near.select("no", F.col("rank").alias("p"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = asked.select("no", F.col("vec_id").alias("anchor_id"))
    return found.join(pairs, ["no", "p"]).join(named, "no").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def inner_products(trace: list) -> tuple[int, int]:
    """(inner products made, anchors x rows) of a traced run; for positives only rows of the anchor's label count."""
    index, *visits = trace
    made = 0
    per_cell = index.table.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    per_label = index.table.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("n"))
    for _, same_label, wanted in visits:
        asked = wanted.select("no", "label", F.explode("cells").alias("cell")).distinct()
        made += asked.join(per_label if same_label else per_cell, ["cell", "label"] if same_label else ["cell"]).agg(F.sum("n")).first()[0] or 0
    return made, index.table.filter("is_anchor").count() * index.rows
