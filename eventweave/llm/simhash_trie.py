"""SimHash near-duplicate detection by a binary-trie self-join (operator 9).

``fingerprints``: 64-bit SimHash of every whole text.  ``link``: all pairs of
fingerprints within the Hamming budget, found by walking pairs of nodes of a
binary trie together.  ``near_duplicates``: one row per document with its
component.

The join: four differing bits leave one third of the word with at most one, so
the trie is built three times, once with each third leading, and a pair of nodes is
dropped when the bits accumulated so far exceed ``budget // 3`` inside the
leading third or ``budget`` below it.  Spark deals the trie out by its top
nodes: a fingerprint goes to its own prefix and to every lower prefix that a
leading third within the budget can reach.  A prefix with many members is cut into
blocks, and every pair of blocks is joined, so no task holds more than two
blocks.  Tasks return a spanning forest of the links they found (never the
pairs of a dense group); connected components join the forests.

Edge cases: a null text reads as empty; texts without words have fingerprint
zero, linked like any other; fewer words than a shingle form one shingle;
repeated rows each get a row; a null ``doc_id`` is ignored when the smallest id
of a component is taken (null if it has no other); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import bytesops as B
from ..operators.components import connected_components

SHINGLE = 4
BUDGET = 4
SEED = 42
#: members of a trie shard above which it is cut into blocks
BLOCK = 20_000
#: fingerprints for each top node of the trie, on average, once there are more than 2^TOP_BITS times as many
TOP_NODE = 2048
TOP_BITS = 8
#: (first bit, bits) of the thirds of a fingerprint
THIRDS = ((0, 22), (22, 21), (43, 21))
#: node pairs expanded at once inside a task
FRONTIER = 1 << 20


def _slice_fingerprints(text: pa.Array, shingle: int, seed: int) -> np.ndarray:
    data, offsets = B.buffers(text)
    start, end, first = B.words(data, offsets)
    out = np.zeros(len(offsets) - 1, dtype=np.uint64)
    if len(start) == 0:
        return out
    # the words, joined by single spaces
    keep = ~B.SPACE[data]
    gap = end[end < len(data)]
    gap = gap[B.SPACE[data[gap]]]
    keep[gap] = True
    data = B.LOWER[data]
    data[gap] = 0x20
    place = np.cumsum(keep)
    start, end = place[start] - 1, place[end - 1]
    joined = data[keep].tobytes()
    count = np.diff(first)
    n = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
    begin = np.zeros(len(first), dtype=np.int64)
    np.cumsum(n, out=begin[1:])
    row = np.repeat(np.arange(len(n)), n)
    a = first[:-1][row] + (np.arange(begin[-1]) - begin[:-1][row])
    z = a + np.minimum(count, shingle)[row] - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter(
        (digest(joined[i:j], seed) for i, j in zip(start[a].tolist(), end[z].tolist(), strict=True)),
        dtype=np.uint64,
        count=int(begin[-1]),
    )
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = n > 0
    ones = np.add.reduceat(bits, begin[:-1][full], axis=0, dtype=np.int64)
    majority = (2 * ones > n[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, with_text_hash: bool = False) -> DataFrame:
    """(doc_id, fp BIGINT): bit i of ``fp`` is 1 if it is set in over half of the
    XXH64 hashes of the text's word shingles (A-Z lower-cased, repeats counted).
    ``with_text_hash`` adds Spark's xxhash64 of the text."""
    extra = ["text_hash"] if with_text_hash else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text"):
                fp = pa.array(_slice_fingerprints(part.column("text"), shingle, seed).view(np.int64))
                cols = [part.column("doc_id"), fp, *[part.column(c) for c in extra]]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "fp", *extra])

    given = docs.select("doc_id", "text", *[F.xxhash64(F.coalesce("text", F.lit(""))).alias(c) for c in extra])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, ", ".join([f"doc_id {kind}", "fp long", *[f"{c} long" for c in extra]]))


# ---------------------------------------------------------------- inside a task


def _levels(x: np.ndarray, depths: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Nodes of the trie over sorted distinct ``x`` at each depth: (prefix, first child
    at the next depth + end); the children of the deepest nodes are the values."""
    nodes = []
    for d in depths:
        prefix = x >> np.uint64(64 - d) if d else np.zeros(len(x), dtype=np.uint64)
        change = np.ones(len(x), dtype=bool)
        change[1:] = prefix[1:] != prefix[:-1]
        nodes.append((prefix[change], np.flatnonzero(change)))
    out = []
    for i, (prefix, at) in enumerate(nodes):
        below = nodes[i + 1][1] if i + 1 < len(nodes) else np.arange(len(x))
        out.append((prefix, np.append(np.searchsorted(below, at), len(below))))
    return out


def trie_links(a: np.ndarray, b: np.ndarray, budget: int, top: int, lead: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with at most ``budget`` differing bits between a[i] and b[j]
    and at most ``budget // 3`` of them in the ``lead`` leading bits.

    ``a``, ``b``: sorted distinct values.  Node pairs are expanded four bits deeper at a
    time or fewer; each carries its accumulated differing bits and is pruned over budget.  The
    frontier is expanded in bounded pieces, deepest first."""
    depths = sorted({0, lead, *range(top + 3, lead, 4), *range(lead + 3, 64, 4), 64})
    ta, tb = _levels(a, depths), _levels(b, depths)
    last = len(depths) - 1
    todo = [(0, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while todo:
        level, i, j, acc = todo.pop()
        if level == last:
            yield i, j
            continue
        ca, cb = ta[level][1], tb[level][1]
        na, nb = ca[i + 1] - ca[i], cb[j + 1] - cb[j]
        size = na * nb
        total = int(size.sum())
        if total > FRONTIER and len(i) > 1:
            half = len(i) // 2
            todo += [(level, i[:half], j[:half], acc[:half]), (level, i[half:], j[half:], acc[half:])]
            continue
        pair = np.repeat(np.arange(len(i)), size)
        k = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        i2, j2 = ca[i][pair] + k // nb[pair], cb[j][pair] + k % nb[pair]
        width = depths[level + 1] - depths[level]
        mask = np.uint64((1 << width) - 1)
        step = np.bitwise_count((ta[level + 1][0][i2] ^ tb[level + 1][0][j2]) & mask) if width < 64 else 0
        acc2 = acc[pair] + step
        ok = acc2 <= (budget // 3 if depths[level + 1] <= lead else budget)
        todo.append((level + 1, i2[ok], j2[ok], acc2[ok]))


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the classes of i and j in ``label`` (smallest index of each class), in place."""
    while True:
        li, lj = label[i], label[j]
        apart = li != lj
        if not apart.any():
            return
        i, j, li, lj = i[apart], j[apart], li[apart], lj[apart]
        np.minimum.at(label, np.maximum(li, lj), np.minimum(li, lj))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def forest(a: np.ndarray, b: np.ndarray, budget: int, top: int, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (value, smallest value of its class) of the links between ``a`` and ``b``."""
    if not len(a) or not len(b):
        return a[:0], a[:0]
    values = np.unique(np.concatenate([a, b]))
    at_a, at_b = np.searchsorted(values, a), np.searchsorted(values, b)
    label = np.arange(len(values))
    for i, j in trie_links(a, b, budget, top, lead):
        _union(label, at_a[i], at_b[j])
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


# ------------------------------------------------------------------- distributed


def link(fps: DataFrame, budget: int = BUDGET, block: int = BLOCK, top_node: int = TOP_NODE) -> DataFrame:
    """(a, b): a spanning forest of the graph whose links join distinct fingerprints
    (column ``fp``, no repeats) of at most ``budget`` differing bits."""
    n = fps.count()
    if not 0 <= budget <= 5:
        raise ValueError("a leading third may differ in one bit at most: budget 0 to 5")
    top = min(20, max(TOP_BITS, math.ceil(math.log2(max(n, 1) / top_node))))
    near = [0] + [1 << i for i in range(top) if budget >= 3]
    turns = [F.struct(F.lit(k).alias("third"), _rotated("fp", first).alias("v")) for k, (first, _) in enumerate(THIRDS)]
    members = (
        fps.select(F.explode(F.array(*turns)).alias("s"))
        .select("s.third", "s.v", F.shiftrightunsigned("s.v", 64 - top).alias("own"))
        .withColumn("flip", F.explode(F.array([F.lit(x).cast("long") for x in near])))
        .withColumn("node", F.col("own").bitwiseXOR(F.col("flip")))
        .filter(F.col("node") <= F.col("own"))
        .select("third", "node", "v", (F.col("flip") == 0).alias("owned"))
    )
    # members of each top node: at most 3 * 2^top rows
    sizes = members.groupBy("third", "node").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes.withColumn("blocks", F.least(F.ceil(F.col("n") / block), F.lit(65535)).cast("int")), "trie_nodes")
    crowded = sizes.filter(F.col("blocks") > 1).select("third", "node", "blocks")
    members = members.join(crowded, ["third", "node"], "left")
    # block (s, t) of a crowded node: owned members of salt s (role 0) against all members of
    # salt t (role 1); elsewhere one row plays both roles (2)
    salt = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    at = lambda s, t, role: F.struct(s.cast("int").alias("s"), t.cast("int").alias("t"), F.lit(role).alias("role"))
    as_member = F.transform(every, lambda s: at(s, salt, 1))
    split = F.when(F.col("owned"), F.concat(F.transform(every, lambda t: at(salt, t, 0)), as_member)).otherwise(as_member)
    whole = F.array(F.when(F.col("owned"), at(F.lit(0), F.lit(0), 2)).otherwise(at(F.lit(0), F.lit(0), 1)))
    dealt = members.withColumn("at", F.explode(F.when(F.col("blocks").isNull(), whole).otherwise(split)))
    key = F.shiftleft(F.col("third").cast("long"), 52) + F.shiftleft("node", 32) + F.shiftleft(F.col("at.s").cast("long"), 16) + F.col("at.t")
    dealt = dealt.select(key.alias("key"), F.col("at.role").alias("role"), "v")

    def shard(table: pa.Table) -> pa.Table:
        role = table.column("role").combine_chunks().to_numpy()
        v = table.column("v").combine_chunks().to_numpy().view(np.uint64)
        first, lead = THIRDS[table.column("key")[0].as_py() >> 52]
        x, y = forest(np.unique(v[role != 1]), np.unique(v[role != 0]), budget, top, lead)
        if first:
            x, y = ((w >> np.uint64(first)) | (w << np.uint64(64 - first)) for w in (x, y))
        return pa.table({"a": x.view(np.int64), "b": y.view(np.int64)})

    return dealt.groupBy("key").applyInArrow(shard, "a long, b long").distinct()


def _rotated(fp: str, by: int) -> Column:
    """``fp`` with bit ``by`` (from the top) leading."""
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else F.col(fp)


def _components(marked: DataFrame, budget: int) -> DataFrame:
    """(fp, root, first): the component of every distinct fingerprint of ``marked``
    (fp, first) and the smallest ``first`` that carries it."""
    distinct = materialize(marked.groupBy("fp").agg(F.min("first").alias("first")), "distinct_fps")
    roots = connected_components(link(distinct.select("fp"), budget)).select(F.col("node").alias("fp"), "root")
    placed = distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    return materialize(placed, "placed_fps")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET, seed: int = SEED) -> DataFrame:
    """(doc_id, fp, component_id): ``component_id`` is the smallest doc_id that can be
    reached over links of at most ``budget`` differing bits, the document's own included."""
    marked = materialize(fingerprints(docs, shingle, seed), "fingerprints")
    placed = _components(marked.select("fp", F.col("doc_id").alias("first")), budget)
    smallest = materialize(placed.groupBy("root").agg(F.min("first").alias("component_id")), "component_ids")
    named = materialize(placed.join(smallest, "root").select("fp", "component_id"), "fp_components")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET, seed: int = SEED) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id (nulls
    last), then the smallest text hash; of rows that agree in both, the one whose
    other columns sort first."""
    other = [c for c in docs.columns if c not in ("doc_id", "text")]
    keys = ["__no_id", "__id", "__text"]
    keyed = docs.withColumns(
        {"__no_id": F.col("doc_id").isNull(), "__id": F.coalesce("doc_id", F.lit(0)), "__text": F.xxhash64(F.coalesce("text", F.lit("")))}
    )
    marked = materialize(fingerprints(docs, shingle, seed, with_text_hash=True), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash"))
    placed = _components(marked.select("fp", first.alias("first")), budget)
    keep = materialize(placed.groupBy("root").agg(F.min("first").alias("first")).select("first.*").toDF(*keys), "kept")
    order = [F.col(c) for c in sorted(other) if not dict(docs.dtypes)[c].startswith("map")] or [F.lit(0)]
    ranked = keyed.join(keep, keys, "left_semi").withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__n") == 1).select(*docs.columns)


def hex_fingerprint(fp: str = "fp") -> Column:
    """The 16 lower-case hex digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
