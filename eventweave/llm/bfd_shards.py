"""Sharding by best-fit-decreasing bin packing (operator 10).

Rows of equal text form a group that no shard border may cut.  Groups, sorted by
size, enter the shard with the tightest remaining capacity, found in a balanced
tree.  Two entry points: ``pack`` deals into a given number of shards of near equal
bytes; ``pack_capacity`` uses as few shards of a fixed capacity as the method finds.

All groups are packed as groups.  What reaches the driver is the number of groups of each
size: at most sqrt(2 * total bytes) rows, as sizes differ.  Groups of one size fill
the tightest shard while it takes them, so a size costs a few steps however many groups
it has.  The result is a quota of groups for each size and shard; groups are numbered within
their size in Spark and fill the quotas in that order.
A group larger than a fair share gets a shard of its own and the rest is
shared by the others.

Slots number the rows of a shard from 0 without gaps, by (doc_id, text digest): the
rows are range-partitioned and written once, so a shard is numbered by many tasks.

Edge cases: a null text reads as empty (both form one group); size is UTF-8 bytes
plus 1, so empty texts count too; repeated rows get slots of their own; null ids come
first; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import INDEX, RANGE, number_within, ranged
from ..session import materialize

SHARDS = 16


class FreeSpace:
    """Bins by remaining capacity in a balanced search tree (an AA tree)."""

    __slots__ = ("root",)

    class _Node:
        __slots__ = ("key", "left", "right", "level")

        def __init__(self, key: tuple[int, int]):
            self.key, self.left, self.right, self.level = key, None, None, 1

    def __init__(self) -> None:
        self.root = None

    @staticmethod
    def _skew(t):
        if t and t.left and t.left.level == t.level:
            up = t.left
            t.left, up.right = up.right, t
            return up
        return t

    @staticmethod
    def _split(t):
        if t and t.right and t.right.right and t.right.right.level == t.level:
            up = t.right
            t.right, up.left = up.left, t
            up.level += 1
            return up
        return t

    def add(self, free: int, number: int) -> None:
        self.root = self._add(self.root, (free, number))

    def _add(self, t, key):
        if t is None:
            return self._Node(key)
        if key < t.key:
            t.left = self._add(t.left, key)
        else:
            t.right = self._add(t.right, key)
        return self._split(self._skew(t))

    def tightest(self, size: int) -> tuple[int, int] | None:
        """(remaining capacity, bin) of the fullest bin that still takes ``size``."""
        best, t = None, self.root
        while t:
            if t.key[0] >= size:
                best, t = t.key, t.left
            else:
                t = t.right
        return best

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def _remove(self, t, key):
        if t is None:
            return None
        if key < t.key:
            t.left = self._remove(t.left, key)
        elif key > t.key:
            t.right = self._remove(t.right, key)
        elif t.left is None and t.right is None:
            return None
        elif t.left is None:
            heir = t.right
            while heir.left:
                heir = heir.left
            t.key, t.right = heir.key, self._remove(t.right, heir.key)
        else:
            heir = t.left
            while heir.right:
                heir = heir.right
            t.key, t.left = heir.key, self._remove(t.left, heir.key)
        least = min(t.left.level if t.left else 0, t.right.level if t.right else 0) + 1
        if least < t.level:
            t.level = least
            if t.right and least < t.right.level:
                t.right.level = least
        t = self._skew(t)
        t.right = self._skew(t.right)
        if t.right:
            t.right.right = self._skew(t.right.right)
        t = self._split(t)
        t.right = self._split(t.right)
        return t


def best_fit_classes(classes: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int]] | None:
    """(size, bin, items) quotas, in order, of best-fit-decreasing over (size, items) classes, largest
    first; an item above ``capacity`` gets a bin of its own.  None as soon as more than ``most``
    bins are needed.  The tightest bin stays the tightest while it takes items of the size."""
    tree, out, bins = FreeSpace(), [], 0
    for size, count in classes:
        while count:
            place = tree.tightest(size)
            if place is None:
                if most is not None and bins == most:
                    return None
                place = (max(capacity, size), bins)
                bins += 1
            else:
                tree.remove(place)
            n = min(count, place[0] // size) if size else count
            tree.add(place[0] - n * size, place[1])
            out.append((size, place[1], n))
            count -= n
    return out


def _classes(sizes: list[int]) -> list[tuple[int, int]]:
    return [(size, sum(1 for _ in run)) for size, run in itertools.groupby(sizes)]


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of each size (given largest first), see ``best_fit_classes``."""
    quotas = best_fit_classes(_classes(sizes), capacity, most)
    return None if quotas is None else [b for _, b, n in quotas for _ in range(n)]


def pack_classes(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Quotas that deal (size, items) classes, largest first, into ``shards`` bins of near equal
    sums: the smallest capacity found for which best-fit-decreasing needs no more bins.  Items
    above a fair share of what is left get bins of their own."""
    out, alone, rest = [], 0, sum(size * n for size, n in classes)
    todo = list(classes)
    while todo and alone < shards - 1 and todo[0][0] * (shards - alone) >= rest:
        size, n = todo[0]
        out.append((size, alone, 1))
        rest -= size
        alone += 1
        todo[:1] = [(size, n - 1)] if n > 1 else []
    if not todo:
        return out
    bins = shards - alone
    low = high = max(todo[0][0], math.ceil(rest / bins))
    step = 1
    while (best := best_fit_classes(todo, high, bins)) is None:
        low, high, step = high + 1, high + step, step * 2
    while low < high:
        middle = (low + high) // 2
        if (found := best_fit_classes(todo, middle, bins)) is None:
            low = middle + 1
        else:
            high, best = middle, found
    return out + [(size, alone + b, n) for size, b, n in best]


def pack_items(sizes: list[int], shards: int) -> list[int]:
    """Bin of each size (given largest first), see ``pack_classes``."""
    return [b for _, b, n in pack_classes(_classes(sizes), shards) for _ in range(n)]


def _quota_rows(quotas: list[tuple[int, int, int]]) -> list[tuple]:
    """(bytes, step, buckets) of each size: bucket i lists the (end, shard) of the quotas that reach
    into numbers i * step to (i + 1) * step - 1, a few on average however many there are."""
    rows = []
    for size, run in itertools.groupby(quotas, key=lambda q: q[0]):
        parts = [(b, n) for _, b, n in run]
        count = sum(n for _, n in parts)
        step = -(-count // len(parts))
        buckets, begin = [[] for _ in range(-(-count // step))], 0
        for b, n in parts:
            for i in range(begin // step, (begin + n - 1) // step + 1):
                buckets[i].append((begin + n, b))
            begin += n
        rows.append((size, step, buckets))
    return rows


def _assigned(docs: DataFrame, group: str, size: str, place) -> DataFrame:
    """``docs`` with ``shard``: groups packed by ``place((bytes, groups) classes, largest first)``."""
    groups = materialize(docs.groupBy(group).agg(F.sum(size).alias("bytes")), "groups")
    # distinct sizes: at most sqrt(2 * total)
    classes = sorted(((r["bytes"], r["n"]) for r in groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    schema = "bytes long, step long, buckets array<array<struct<end:long,shard:int>>>"
    quotas = docs.sparkSession.createDataFrame(_quota_rows(place(classes)), schema)
    numbered = number_within(groups, ["bytes"], [group], "__at").join(quotas, "bytes")
    at = F.col("__at") - 1
    bucket = F.element_at("buckets", (F.floor(at / F.col("step")) + 1).cast("int"))
    shard = F.element_at(F.filter(bucket, lambda q: q["end"] > at), 1)["shard"]
    placed = numbered.select(F.col(group).alias("__g"), shard.alias("shard"))
    return docs.join(placed, F.col(group) == F.col("__g"), "left").drop("__g")


def _slots(assigned: DataFrame, order: list[str]) -> DataFrame:
    staged = ranged(assigned, ["shard"], order)
    # one row a shard and range: bounded by shards + shuffle partitions
    borders = staged.groupBy("shard", RANGE).agg(F.min(INDEX).alias("__low"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    borders = borders.select("shard", RANGE, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__low")).alias("__shift"))
    return staged.join(F.broadcast(borders), ["shard", RANGE]).withColumn("slot", F.col(INDEX) + F.col("__shift")).drop(RANGE, INDEX, "__shift")


def text_columns(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes + 1), ``text_crc32`` and ``text_md5`` (in place of
    columns of these names); a null text reads as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"size": F.octet_length(text).cast("long") + 1, "text_crc32": F.crc32(text.cast("binary")), "text_md5": F.md5(text.cast("binary"))})


def pack(sized: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``sized`` (size, text_md5, doc_id, any columns) with ``shard`` and ``slot``, in place of columns of these names."""
    return _slots(_assigned(sized.drop("shard", "slot"), "text_md5", "size", lambda c: pack_classes(c, shards)), ["doc_id", "text_md5"])


def pack_capacity(sized: DataFrame, capacity: int) -> DataFrame:
    """``sized`` with ``shard`` and ``slot``: shards of ``capacity`` bytes, as few as the method
    finds (a group above the capacity fills one alone)."""
    return _slots(_assigned(sized.drop("shard", "slot"), "text_md5", "size", lambda c: best_fit_classes(c, capacity)), ["doc_id", "text_md5"])
