"""Mixing sources to target weights by entropy balancing (operator 8).

``targets`` shares ``share`` times all words out to the sources by weight; a target stops
at ``limit`` times its source's size and the excess is shared anew by weight among the
others until none is above.  ``rates`` solves the entropy-balancing problem: among all
document rates between 0 and ``limit`` that meet every source's target in words, the one
of least word-weighted relative entropy to the documents' base rates.  Its solution is an
exponential tilt of the base odds, ``rate = limit * s / (1 + s)`` with ``s = odds(base /
limit) * exp(lambda of the source)``, and the convex dual in lambda is solved by
Newton steps, each a grouped aggregation over (source, base rate) cells.  ``copies``
rounds the rates to whole copies by running sums in order of size: inside a source
the copies of any run of documents differ from the sum of their rates by less than
one, so (sizes being sorted) its words differ from the target by less than its
longest document.  Then, a few times, the largest documents that together fit the words
still missing (or too many) get one copy more (or less) in every source.

Everything stays in Spark tables: sources may be many, and one source may hold most
rows (running sums go by written ranges of rows, see ``operators.ordered``).

Edge cases: a null text has size 0; a null source is a source of its own, last in
order; documents of size 0 get copies by their source's rate and take no words;
repeated rows are rows like any other; an empty table gives an empty result; reruns
agree, as order is by (size, hash of doc_id, doc_id, text hash) and rates are summed as whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import INDEX, RANGE, join_null_safe, number_within, range_offsets, ranged
from ..session import discard, materialize
from . import bytesops as B

SHARE = 1.5
LIMIT = 2
WEIGHTS = (5, 2, 1)
#: rates are summed in units of 2^-24 copies
UNIT = 1 << 24


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text_hash, size): words ``[^\\x20\\x09-\\x0D]+`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text"):
                _, _, first = B.words(*B.buffers(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("source"), part.column("text_hash"), pa.array(np.diff(first))],
                    ["doc_id", "source", "text_hash", "size"],
                )

    given = docs.select("doc_id", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, source string, text_hash long, size long")


def targets(sized: DataFrame, share: float = SHARE, limit: float = LIMIT, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size, weight, target) as a written table."""
    by = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source_sizes")
    ranked = number_within(by, [], ["source asc nulls last"], "n")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1).cast("int"))
    table = materialize(ranked.select("source", "source_size", weight.alias("weight")), "source_weights")
    most = F.col("source_size") * F.lit(float(limit))
    total, heavy = table.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * (total or 0)
    level, stopped = (wanted / heavy if heavy else 0.0), -1
    while True:  # each round stops at least one more source, few rounds in practice
        full = most <= F.col("weight") * F.lit(level)
        n, held, rest = table.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, most)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))
        ).first()
        if n == stopped:
            break
        stopped = n
        if rest > 0:
            level = (wanted - held) / rest
    return table.withColumn("target", F.least(most, F.col("weight") * F.lit(level)))


def rates(cells: DataFrame, goals: DataFrame, limit: float = LIMIT, tolerance: float = 1e-9, max_steps: int = 60) -> DataFrame:
    """(source, lam, full): the tilt of every source, by Newton on the dual.

    ``cells(source, base, words)``: words by source and base rate (0 < base < limit);
    ``goals(source, source_size, target)``.  ``full`` marks sources whose target takes
    all of them ``limit`` times, which no finite tilt reaches."""
    full = F.col("target") >= F.col("source_size") * limit * (1 - 1e-12)
    at = goals.select("source", "target", full.alias("full"), F.lit(0.0).alias("lam"))
    written = None
    for _ in range(max_steps):
        joined = join_null_safe(cells, at.filter(~F.col("full") & (F.col("target") > 0)), ["source"])
        p = _tilted(F.col("base"), F.col("lam"), limit) / limit
        step = joined.groupBy("source").agg(
            (F.sum(F.col("words") * limit * p) - F.first("target")).alias("gradient"),
            F.sum(F.col("words") * limit * p * (1 - p)).alias("curvature"),
        )
        moved = F.greatest(F.lit(-4.0), F.least(F.lit(4.0), F.col("gradient") / F.col("curvature")))
        following = materialize(
            join_null_safe(at, step, ["source"], "left").select(
                "source", "target", "full", (F.col("lam") - F.coalesce(moved, F.lit(0.0))).alias("lam"), (F.abs("gradient") / F.col("target")).alias("off")
            ),
            "tilts",
        )
        if written is not None:
            discard(written)
        at = written = following
        if (following.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            return at.drop("off")
    raise RuntimeError("entropy balancing did not converge")


def _tilted(base: Column, lam: Column, limit: float) -> Column:
    odds = base / (F.lit(float(limit)) - base) * F.exp(lam)
    return F.lit(float(limit)) * odds / (F.lit(1.0) + odds)


def copies(sized: DataFrame, share: float = SHARE, limit: int = LIMIT, weights: tuple = WEIGHTS, base: Column | None = None) -> DataFrame:
    """``sized`` (see :func:`sizes`) with source_size, target, rate, copies and taken words.

    ``base``: base rate of each document from its columns (default 1)."""
    base = F.lit(1.0) if base is None else base.cast("double")
    sized = materialize(sized.withColumn("base", base), "sizes")
    goals = materialize(targets(sized, share, limit, weights), "targets")
    cells = materialize(sized.groupBy("source", "base").agg(F.sum("size").cast("double").alias("words")), "cells")
    tilts = rates(cells, goals, limit)
    tilted = join_null_safe(goals.drop("weight"), tilts.drop("target"), ["source"])
    rated = join_null_safe(sized, materialize(tilted, "tilted"), ["source"])
    rate = F.when(F.col("full"), F.lit(float(limit))).when(F.col("target") <= 0, F.lit(0.0)).otherwise(_tilted(F.col("base"), F.col("lam"), limit))
    rated = rated.withColumn("rate", rate).withColumn("units", F.round(F.col("rate") * UNIT).cast("long"))
    rows = ranged(
        rated.withColumn("mixed", F.xxhash64("doc_id")).drop("lam", "full", "base"), ["source"], ["size", "mixed", "doc_id", "text_hash"]
    )
    offsets = range_offsets(rows, ["source"], F.col("units"))
    running = F.sum("units").over(Window.partitionBy("source", RANGE).orderBy(INDEX).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = join_null_safe(rows.withColumn("upto", running), offsets, ["source", RANGE])
    upto = F.col("upto") + F.col("__off") + UNIT // 2
    whole = F.shiftright(upto, 24) - F.shiftright(upto - F.col("units"), 24)
    rounded = materialize(summed.withColumn("copies", whole.cast("int")).drop("__off", "upto", "units", "mixed"), "rounded")
    return _settled(rounded, limit).withColumn("taken", F.col("copies") * F.col("size")).drop(RANGE, INDEX)


def _settled(rounded: DataFrame, limit: int, rounds: int = 3) -> DataFrame:
    """Bring every source's words nearer its target: each round, of the documents no longer
    than the words still missing (or too many), the largest ones that fit together get
    one copy more (or less).  Running sums go by the rows' written ranges."""
    at = rounded
    for _ in range(rounds):
        off = materialize(at.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("off")), "off_target")
        near = join_null_safe(at, off, ["source"])
        free = F.when(F.col("off") > 0, F.col("copies") < limit).otherwise(F.col("copies") > 0)
        fits = (F.col("size") > 0) & free & (F.col("size") <= F.abs("off"))
        near = near.withColumn("words", F.when(fits, F.col("size")).otherwise(0))
        larger = Window.partitionBy("source").orderBy(F.col(RANGE).desc()).rowsBetween(Window.unboundedPreceding, -1)
        above = near.groupBy("source", RANGE).agg(F.sum("words").alias("n"))
        above = above.select("source", RANGE, F.coalesce(F.sum("n").over(larger), F.lit(0)).alias("above"))
        down = Window.partitionBy("source", RANGE).orderBy(F.col(INDEX).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        near = join_null_safe(near.withColumn("sum", F.sum("words").over(down)), above, ["source", RANGE])
        moved = (F.col("words") > 0) & (F.col("sum") + F.col("above") <= F.abs("off"))
        copies = F.col("copies") + F.when(moved, F.signum("off").cast("int")).otherwise(0)
        following = materialize(near.withColumn("copies", copies.cast("int")).select(*rounded.columns), "settled")
        discard(at, off)
        at = following
    return at


def mix(docs: DataFrame, share: float = SHARE, limit: int = LIMIT, weights: tuple = WEIGHTS) -> DataFrame:
    """The mixed table: every row of ``docs`` as often as its copies say (all columns).

    Copies are decided on slim rows and brought back by (doc_id, source, text hash); rows
    that agree in all three share their copies out evenly."""
    keys = ["__no_id", "__id", "__source", "__text"]
    key = {
        "__no_id": F.col("doc_id").isNull(),
        "__id": F.coalesce("doc_id", F.lit(0)),
        "__source": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
    }
    decided = copies(sizes(docs), share, limit, weights).withColumns(key).withColumn("__text", F.col("text_hash"))
    decided = materialize(decided.groupBy(*keys).agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows")), "copies")
    keyed = docs.withColumns(key | {"__text": F.xxhash64(F.coalesce("text", F.lit("")))})
    joined = keyed.join(decided.filter(F.col("__copies") > 0), keys)
    order = [c for c in sorted(docs.columns) if c not in ("doc_id", "source", "text") and not dict(docs.dtypes)[c].startswith("map")]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c) for c in order] or [F.lit(0)]))
    mine = F.floor((nth * F.col("__copies")) / F.col("__rows")) - F.floor(((nth - 1) * F.col("__copies")) / F.col("__rows"))
    repeated = joined.withColumn("__mine", mine.cast("int")).filter(F.col("__mine") > 0)
    return repeated.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__mine")))).select(*docs.columns)
