"""Benchmark decontamination: size-partitioned MinHash containment search (operator 7).

Finds short test items inside long documents.  An item of n distinct word shingles is
contained in a document that holds at least ``threshold * n`` of them, so at most
``floor((1 - threshold) * n)`` are missing and any larger set of its shingles has one
in the document.  Items are therefore partitioned by size (n, by powers of two), and
each partition gets its own MinHash length: the bottom ``floor((1 - threshold) *
largest n of the partition) + 1`` hashes of an item form its signature.  A document
whose shingle hashes hit no signature contains no item; every hit is a candidate,
checked first on all hashes of the item (equal shingles have equal hashes, so nothing
is lost) and then on the shingles themselves.

The items are the stated query set: they are searched in blocks of a bounded number of
bytes, and each block's signatures go to all tasks.  Documents are never shuffled.

Words are maximal runs of letters and digits (ASCII; bytes above 0x7F count as
letters) of the lower-cased text.  Edge cases: a null or wordless text contains
nothing and an item without words is contained nowhere; fewer words than a shingle form one
shingle, the whole sequence, so such an item is found in the texts that consist of
it; repeated documents and repeated items each keep their rows; null ids stay null;
empty tables give empty results; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesops as B

SHINGLE = 5
THRESHOLD = 0.8
#: bytes of normalised item text in a block (collected to the driver and sent to the tasks)
ITEM_BLOCK = 16 << 20


def _words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = B.buffers(pc.utf8_lower(text))
    return data, *B.words(data, offsets, B.NOT_ALNUM)


def _normalised(text: pa.Array) -> list[bytes]:
    data, start, end, first = _words(text)
    raw = data.tobytes()
    found = [raw[i:j] for i, j in zip(start.tolist(), end.tolist(), strict=True)]
    return [b" ".join(found[i:j]) for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def _shingles(normal: bytes, k: int) -> set[bytes]:
    w = normal.split(b" ")
    return {b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


class Signatures:
    """The bottom-k MinHash signatures of a block of items, ready to be probed."""

    def __init__(self, items: list[bytes], shingle: int, threshold: float):
        self.items, self.shingle, self.threshold = items, shingle, threshold
        data, start, end, first = _words(pa.array([x.decode("utf-8", "replace") for x in items], pa.string()))
        hashes, begin = B.shingle_hashes(B.word_hashes(data, start, end), first, shingle)
        self.hashes = [np.unique(hashes[i:j]) for i, j in zip(begin[:-1], begin[1:], strict=True)]
        keys, owner = [], []
        for n, h in enumerate(self.hashes):
            if len(h):
                largest = (1 << int(len(h)).bit_length()) - 1  # of the item's size partition
                keys.append(h[: int((1 - threshold) * largest + 1e-9) + 1])  # np.unique sorts: the smallest hashes
                owner.append(np.full(len(keys[-1]), n))
        key = np.concatenate(keys) if keys else np.empty(0, dtype=np.uint64)
        own = np.concatenate(owner) if owner else np.empty(0, dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.owner = key[order], own[order]
        self.mask = np.zeros(1 << 22, dtype=bool)
        self.mask[(self.key >> np.uint64(42)).astype(np.int64)] = True

    def probe(self, text: pa.Array) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, shingles of the item, shingles found) of every containment."""
        data, start, end, first = _words(text)
        hashes, begin = B.shingle_hashes(B.word_hashes(data, start, end), first, self.shingle)
        near = np.flatnonzero(self.mask[(hashes >> np.uint64(42)).astype(np.int64)])
        lo = np.searchsorted(self.key, hashes[near], side="left")
        hi = np.searchsorted(self.key, hashes[near], side="right")
        size = hi - lo
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        row = np.repeat(np.searchsorted(begin, near, side="right") - 1, size)
        last, exact, sorted_hashes = -1, None, None
        for r, n in sorted(set(zip(row.tolist(), self.owner[at].tolist(), strict=True))):
            if r != last:
                last, exact = r, None
                sorted_hashes = np.unique(hashes[begin[r] : begin[r + 1]])
            mine = self.hashes[n]
            if np.isin(mine, sorted_hashes, assume_unique=True).sum() < self.threshold * len(mine) - 1e-9:
                continue
            if exact is None:
                s, e = start[first[r] : first[r + 1]], end[first[r] : first[r + 1]]
                raw = data[s[0] : e[-1]].tobytes()
                exact = _shingles(b" ".join(raw[i:j] for i, j in zip((s - s[0]).tolist(), (e - s[0]).tolist(), strict=True)), self.shingle)
            wanted = _shingles(self.items[n], self.shingle)
            found = len(wanted & exact)
            if found >= self.threshold * len(wanted) - 1e-9:
                yield r, n, len(wanted), found


def _item_blocks(items: DataFrame, block_bytes: int) -> tuple[DataFrame, Iterator[list[bytes]]]:
    """The items with their normalised text, and the distinct texts in bounded blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in B.slices(batch, "text"):
                normal = pa.array([x.decode("utf-8", "replace") for x in _normalised(part.column("text"))], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("item_id"), normal], ["item_id", "item"])

    kind = items.schema["item_id"].dataType.simpleString()
    named = items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, item string").filter("item != ''")
    texts = named.select("item").distinct()
    total = texts.agg(F.sum(F.octet_length("item") + 64)).first()[0] or 0
    n = int(total // block_bytes) + 1 if total else 0

    def blocks() -> Iterator[list[bytes]]:
        for k in range(n):
            part = texts.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k) if n > 1 else texts
            yield sorted(r["item"].encode() for r in part.collect())

    return named, blocks()


def contained_items(
    docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, block_bytes: int = ITEM_BLOCK
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment): every pair whose document
    holds at least ``threshold`` of the item's distinct shingles."""
    named, blocks = _item_blocks(items, block_bytes)
    sc = docs.sparkSession.sparkContext
    given = docs.select("doc_id", "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item string, n_shingles int, n_found int"
    found = docs.sparkSession.createDataFrame([], schema)
    for block in blocks:
        sent = sc.broadcast(Signatures(block, shingle, threshold))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            signatures = sent.value
            for batch in batches:
                for part in B.slices(batch, "text"):
                    hits = list(signatures.probe(part.column("text")))
                    if hits:
                        row, item, n, m = zip(*hits, strict=True)
                        names = pa.array([signatures.items[i].decode("utf-8", "replace") for i in item], pa.string())
                        ids = part.column("doc_id").take(pa.array(row))
                        yield pa.RecordBatch.from_arrays([ids, names, pa.array(n, pa.int32()), pa.array(m, pa.int32())], ["doc_id", "item", "n_shingles", "n_found"])

        found = found.unionByName(given.mapInArrow(run, schema))
    return found.join(named, "item").select("doc_id", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment"))


def decontaminate(
    docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, block_bytes: int = ITEM_BLOCK
) -> DataFrame:
    """The rows of ``docs`` (all columns) that contain no item."""
    _, blocks = _item_blocks(items, block_bytes)
    sc = docs.sparkSession.sparkContext
    for block in blocks:
        sent = sc.broadcast(Signatures(block, shingle, threshold))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            signatures = sent.value
            for batch in batches:
                for part in B.slices(batch, "text"):
                    clean = np.ones(part.num_rows, dtype=bool)
                    clean[[r for r, *_ in signatures.probe(part.column("text"))]] = False
                    yield part if clean.all() else part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
