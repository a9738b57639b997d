"""Language-model scoring by prediction by partial matching (operator 3).

The model is a byte-context trie: for every context of up to ``ORDER`` bytes, the bytes
(or the end of text) that follow it and how often.  A symbol is coded in the longest known
context; if it was never seen there, an escape is coded (method D: every distinct symbol
gives half a count to the escape) and the next shorter context is asked, without the symbols that
the longer one already offered (exclusion).  Below the empty context, the symbols never seen are
equally likely.

Counting is single: the corpus' counts go to the longest contexts, and a shorter one
counts the distinct longer nodes that end in it, which is how often it would be asked.

Pretrained on a corpus, the trie never goes to one place.  A trie node is a number
(nine bits a symbol).  All contexts that a symbol can back off to share its last
context bytes, so the nodes are dealt out by the last two, or by the last three where more than
``CROWD`` nodes share two: each task holds whole sub-tries (contexts of no or one byte, at most
66,049 nodes, and the 257 nodes at most of each crowded context of two go to all tasks) and
finds the cost of every distinct deepest node (a symbol in its longest context) that
any document mentions.  Documents are scored in blocks of a bounded number of bytes:
the pass that counts writes, for each block, its texts (compressed) and the distinct
deepest nodes in it; these are joined with their costs, and each block is scored with
just its own.  ``adaptive_code_length`` is the same model learning from
the text alone, symbol by symbol.

The add-one unigram baseline (``base_score``) goes the same way with words for nodes.

Edge cases: a null text reads as empty (one end symbol); repeated rows are scored
alike (and all count in training); a null ``doc_id`` has the remainder of an empty id (0); without
training rows every symbol costs the same; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.taskcontext import TaskContext

from ..session import discard, materialize
from . import bytesops as B

ORDER = 5
#: symbols: 256 bytes and the end of text
ALPHABET = 257
BITS = 9
#: bytes of text scored with one set of nodes
BLOCK = 32 << 20
#: bytes of text turned into nodes at once
PIECE = 1 << 19
#: distinct nodes or words of pieces that wait to be merged
PENDING = 1 << 19
#: nodes of one task that finds costs; contexts of two symbols with more are split by a third
CROWD = 1 << 20
#: zstd level of packed texts, which are written and shuffled once each: a sixth smaller than at level 1
LEVEL = 6


# ------------------------------------------------------------------ inside a task


def windows(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The deepest node of every symbol (its context of up to ``order`` symbols and itself,
    as a number) and the row borders; each row ends with the end symbol."""
    rows = len(offsets) - 1
    at = offsets + np.arange(rows + 1)  # borders with one end symbol a row
    symbol = np.empty(int(at[-1]), dtype=np.int64)
    symbol[at[1:] - 1] = ALPHABET  # stored as symbol + 1, so 257 is the end
    body = np.ones(len(symbol), dtype=bool)
    body[at[1:] - 1] = False
    symbol[body] = B.LOWER[data].astype(np.int64) + 1
    node = symbol.copy()
    for back in range(1, order + 1):
        node[back:] |= symbol[:-back] << (BITS * back)
    for place in range(order):  # a row's first symbols see none of the row before
        here = at[:-1][np.diff(at) > place] + place
        node[here] &= _mask(place + 1)
    return node, at


def _mask(symbols: int) -> int:
    return (1 << (BITS * symbols)) - 1


def _symbols(node: np.ndarray, most: int) -> np.ndarray:
    """How many symbols each node holds."""
    out = np.ones(len(node), dtype=np.int64)
    for k in range(1, most):
        out[node >> (BITS * k) > 0] = k + 1
    return out


def _merged(node: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes, sorted, with their summed counts; sums runs of the sorted nodes, which takes half the memory of
    numbering them.  The stable sort merges parts that are sorted already."""
    if not len(node):
        return node, n
    order = np.argsort(node, kind="stable")
    node, n = node[order], n[order]
    del order
    at = _run_starts(node)
    return node[at], np.add.reduceat(n, at).astype(float)


def _run_starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return np.flatnonzero(new)


def _counted(node: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes, sorted, and how many of each are marked; the mark is the sorted number's last bit."""
    both = (node << 1) | train
    both.sort()
    node = both >> 1
    at = _run_starts(node)
    return node[at], np.add.reduceat(both & 1, at).astype(float)


def _places(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``searchsorted`` in order of ``wanted``: neighbours in it are neighbours in memory."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted), dtype=np.int64)
    out[order] = np.searchsorted(known, wanted[order])
    return out


def _spelled(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of the words between ``start`` and ``end``."""
    border = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(end - start, out=border[1:])
    body = data[np.repeat(start - border[:-1], end - start) + np.arange(border[-1])]
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(border), pa.py_buffer(body)]).cast(pa.binary())


class Words:
    """Distinct words with counts, told apart by two 64-bit hashes; ``words`` has their bytes."""

    def __init__(self, first: np.ndarray, second: np.ndarray, count: np.ndarray, words: pa.Array):
        self.first, self.second, self.count, self.words = first, second, count, words

    @classmethod
    def merged(cls, parts: list[Words]) -> Words:
        first, second, count = (np.concatenate([getattr(p, x) for p in parts]) for x in ("first", "second", "count"))
        words = pa.concat_arrays([p.words for p in parts])
        at, code = np.unique(first, return_index=True, return_inverse=True)[1:]
        if not (second[at][code] == second).all():  # two words with one first hash: sort by both
            order = np.lexsort((second, first))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
            at, code = order[new], np.empty(len(order), dtype=np.int64)
            code[order] = np.cumsum(new) - 1
        total = np.bincount(code, count, len(at)).astype(np.int64)
        return cls(first[at], second[at], total, words.take(pa.array(at)))

    def lookup(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of words given by their hashes, 0 for unknown ones; needs words in order of both hashes."""
        out = np.zeros(len(first))
        if len(self.first):
            at = np.minimum(_places(self.first, first), len(self.first) - 1)
            for _ in range(self._ties):
                hit = (self.first[at] == first) & (self.second[at] == second)
                out[hit] = self.count[at][hit]
                at = np.minimum(at + 1, len(self.first) - 1)
        return out

    @cached_property
    def _ties(self) -> int:
        """The most words that share a first hash; found once, a vocabulary serves many lookups."""
        return int(np.unique(self.first, return_counts=True)[1].max())


class Trie:
    """A (part of a) trie: for each number of symbols the known nodes with their counts, and
    for each context what it offers and what its shorter context has left after exclusion.

    ``deepest``, ``n``: deepest nodes and corpus counts.  ``shallow``: nodes of one and two
    symbols with their counts where these come from the whole trie (else they are counted here);
    ``crowded``: the nodes of three symbols below split contexts, likewise."""

    def __init__(self, deepest: np.ndarray, n: np.ndarray, order: int, shallow: dict[int, tuple] | None = None, crowded: tuple | None = None):
        self.order = order
        known = n > 0
        deepest, n = deepest[known], n[known].astype(float)
        size = _symbols(deepest, order + 1)
        self.level: dict[int, tuple] = {}
        longer = np.empty(0, dtype=np.int64)
        for k in range(order + 1, 0, -1):
            if shallow is not None and k in shallow:
                self.level[k] = shallow[k]
            else:  # its own corpus counts, and one for each longer node that ends in it
                own = size == k
                ends = longer & _mask(k)
                node, count = np.concatenate([deepest[own], ends]), np.concatenate([n[own], np.ones(len(ends))])
                if k == 3 and crowded is not None:  # here only in part: the whole trie's take their place
                    rest = ~np.isin(node >> BITS, crowded[0] >> BITS)
                    node, count = np.concatenate([node[rest], crowded[0]]), np.concatenate([count[rest], crowded[1]])
                self.level[k] = _merged(node, count)
            longer = self.level[k][0]
        self.context: dict[int, tuple] = {}
        for k in range(1, order + 2):  # contexts of k - 1 symbols
            node, count = self.level[k]
            at, code = np.unique(node >> BITS, return_inverse=True)
            total, kinds = np.bincount(code, count, len(at)), np.bincount(code, minlength=len(at)).astype(float)
            left, new = total, kinds
            if k > 1 and len(at):
                below, below_count = self.level[k - 1]
                excluded = np.bincount(code, below_count[np.searchsorted(below, node & _mask(k - 1))], len(at))
                up = np.searchsorted(self.context[k - 1][0], at & _mask(k - 2))
                left, new = self.context[k - 1][1][up] - excluded, self.context[k - 1][2][up] - kinds
            self.context[k] = (at, total, kinds, left, new)

    def log10(self, node: np.ndarray) -> np.ndarray:
        """log10 probability of each deepest node's symbol in its context."""
        out = np.zeros(len(node))
        size = _symbols(node, self.order + 1)
        todo = np.ones(len(node), dtype=bool)
        total, kinds = np.zeros(len(node)), np.zeros(len(node))  # offered by the context asked next
        escaped = np.zeros(len(node), dtype=bool)
        for k in range(self.order + 1, 0, -1):
            at, all_total, all_kinds, left, new = self.context[k]
            here = np.flatnonzero(todo & (size >= k))
            if not len(here) or not len(at):
                continue
            context = (node[here] & _mask(k)) >> BITS
            c = np.minimum(np.searchsorted(at, context), len(at) - 1)
            known = at[c] == context
            here, c = here[known], c[known]
            offered = np.where(escaped[here], total[here], all_total[c])
            options = np.where(escaped[here], kinds[here], all_kinds[c])
            seen, count = self.level[k]
            mine = node[here] & _mask(k)
            s = np.minimum(np.searchsorted(seen, mine), len(seen) - 1)
            hit = seen[s] == mine
            # a symbol: its count less the half that goes to the escape; nothing new to offer: the escape is certain
            weight = np.where(hit, count[s] - 0.5, options / 2)
            sure = ~hit & (options <= 0)
            out[here[~sure]] += np.log10(weight[~sure] / offered[~sure])
            todo[here[hit]] = False
            total[here], kinds[here], escaped[here] = left[c], new[c], True
        alphabet = self.context[1][2]
        out[todo] -= math.log10(max(1.0, ALPHABET - (alphabet[0] if len(alphabet) else 0.0)))
        return out


def adaptive_code_length(text: bytes, order: int = ORDER) -> float:
    """log10 probability of ``text`` and its end under the model that learns from it alone
    (a symbol is counted in the context that coded it and the longer ones)."""
    trie: dict[tuple, dict[int, int]] = defaultdict(dict)
    history, out = (), 0.0
    for symbol in [*text.lower(), ALPHABET - 1]:
        excluded: set[int] = set()
        coded = 0
        for k in range(min(order, len(history)), -1, -1):
            seen = {s: n for s, n in trie[history[len(history) - k :]].items() if s not in excluded}
            if not seen:
                continue
            total = sum(seen.values())
            if symbol in seen:
                out += math.log10((seen[symbol] - 0.5) / total)
                coded = k
                break
            out += math.log10(len(seen) / 2 / total)
            excluded |= set(seen)
        else:
            out -= math.log10(ALPHABET - len(excluded))
        for k in range(coded, min(order, len(history)) + 1):
            node = trie[history[len(history) - k :]]
            node[symbol] = node.get(symbol, 0) + 1
        history = (*history, symbol)[-order:] if order else ()
    return out


# -------------------------------------------------------------------- distributed


def held_out_fold(doc_id: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    """The documents to score only: crc32 of the id's text leaves ``fold`` modulo ``folds``."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def _blocks(docs: DataFrame, order: int, block_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One pass over (doc_id, text, held_out): written tables of the texts by block (packed),
    of the distinct deepest nodes of each block and of its words, with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = (context.partitionId() if context else 0) << 24  # its rows are what makes a block, not its number
        packed = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))
        nodes: list[tuple[np.ndarray, np.ndarray]] = []
        words: list[Words] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if nodes:
                node, n = _merged(*(np.concatenate(x) for x in zip(*nodes, strict=True)))
                yield _rows("node", name, len(node), node=pa.array(node), n=pa.array(n.astype(np.int64)))
            if words:
                w = Words.merged(words)
                yield _rows("word", name, len(w.count), word=w.words, n=pa.array(w.count))

        for batch in batches:
            for part in B.slices(batch, "text", PIECE):
                data, offsets = B.buffers(part.column("text"))
                if held and held + len(data) > block_bytes:
                    yield from flush()
                    nodes, words, held, name = [], [], 0, name + 1
                held += len(data) + part.num_rows
                train = ~part.column("held_out").to_numpy(zero_copy_only=False)
                node, at = windows(data, offsets, order)
                nodes.append(_counted(node, np.repeat(train, np.diff(at)).astype(np.int64)))
                del node
                if sum(len(x) for x, _ in nodes[1:]) > PENDING:
                    nodes = [_merged(*(np.concatenate(x) for x in zip(*nodes, strict=True)))]
                lower = B.LOWER[data]
                start, end, first = B.words(lower, offsets)
                if len(start):
                    hashes = [B.word_hashes(lower, start, end, k) for k in (0, 1)]
                    of = np.repeat(train, np.diff(first)).astype(np.int64)
                    code, at = np.unique(hashes[0], return_index=True, return_inverse=True)[2:0:-1]
                    if not (hashes[1][at][code] == hashes[1]).all():
                        at, code = np.arange(len(start)), None  # rare: leave all to the merge
                    count = of if code is None else np.bincount(code, of, len(at)).astype(np.int64)
                    words.append(Words(hashes[0][at], hashes[1][at], count, _spelled(lower, start[at], end[at])))
                    if sum(len(w.count) for w in words[1:]) > PENDING:
                        words = [Words.merged(words)]
                texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.copy()), pa.py_buffer(lower)])
                rows = pa.RecordBatch.from_arrays([part.column("doc_id"), texts, part.column("held_out")], ["doc_id", "text", "held_out"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=packed) as out:
                    out.write_batch(rows)
                yield _rows("text", name, 1, texts=pa.array([sink.getvalue().to_pybytes()], pa.binary()), n=pa.array([int(train.sum())], pa.int64()))
        yield from flush()
        nodes, words = [], []
        B.release()

    types = {"texts": pa.binary(), "node": pa.int64(), "word": pa.binary(), "n": pa.int64()}

    def _rows(what: str, block: int, size: int, **given) -> pa.RecordBatch:
        filled = [given[c] if c in given else pa.nulls(size, t) for c, t in types.items()]
        return pa.RecordBatch.from_arrays([pa.array([what] * size, pa.string()), pa.array(np.full(size, block)), *filled], ["what", "block", *types])

    schema = "what string, block long, texts binary, node long, word binary, n long"
    written = materialize(docs.mapInArrow(run, schema), "ppm_blocks", partition_by=["what"], compression="zstd")
    part = lambda what, *cols: written.filter(F.col("what") == what).select("block", *cols)
    return part("text", "texts", "n"), part("node", "node", "n"), part("word", "word", "n")


def node_costs(counted: DataFrame, order: int = ORDER, crowd: int = CROWD) -> DataFrame:
    """(known, value): log10 probability of every deepest node of (node, n), distinct nodes, where
    n is a node's count in training (0: only mentioned by documents to score)."""
    known = counted.filter("n > 0")
    ends_in = lambda k: F.col("node").bitwiseAND(F.lit(_mask(k)))
    exactly = lambda k: (F.col("node") >= (1 << (BITS * (k - 1)))) & (F.col("node") < (1 << (BITS * k)))
    # nodes of two and one symbols, each counting the distinct longer nodes that end in it
    three = known.filter(F.col("node") >= (1 << (2 * BITS))).select(ends_in(3).alias("node")).distinct()
    two = three.select(ends_in(2).alias("node"), F.lit(1).alias("n")).unionByName(known.filter(exactly(2))) if order > 1 else known.filter(exactly(2))
    one = known.filter(exactly(1))
    gathered = {k: [(r["node"], r["n"]) for r in t.groupBy("node").agg(F.sum("n").alias("n")).collect()] for k, t in ((2, two), (1, one))}
    arrays = {k: _merged(np.array([x for x, _ in v], dtype=np.int64), np.array([n for _, n in v], dtype=float)) for k, v in gathered.items()}
    ends = arrays[2][0] & _mask(1)
    arrays[1] = _merged(np.concatenate([arrays[1][0], ends]), np.concatenate([arrays[1][1], np.ones(len(ends))]))
    shallow = {k: v for k, v in arrays.items() if k <= order + 1}
    # contexts of two symbols with too many nodes for a task, and the nodes of three symbols below them
    last_two = F.shiftright("node", BITS).bitwiseAND(F.lit(_mask(2)))
    sizes = counted.groupBy(last_two.alias("context")).agg(F.count(F.lit(1)).alias("size")).agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("all"), F.collect_list(F.when(F.col("size") > crowd, F.col("context"))).alias("split")
    )
    size, split = sizes.first()
    split = [c for c in split if c >= 1 << BITS] if order > 2 else []
    crowded = None
    if split:
        below = known.filter(last_two.isin(split))
        four = below.filter(F.col("node") >= (1 << (3 * BITS))).select(ends_in(4).alias("node")).distinct()
        three = four.select(ends_in(3).alias("node"), F.lit(1).alias("n")).unionByName(below.filter(exactly(3)))
        rows = three.groupBy("node").agg(F.sum("n").alias("n")).collect()
        crowded = _merged(np.array([r["node"] for r in rows], dtype=np.int64), np.array([r["n"] for r in rows], dtype=float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema([("node", pa.int64()), ("n", pa.int64())]))
        node, n = (table.column(c).to_numpy() for c in ("node", "n"))
        if len(node):
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(Trie(node, n, order, shallow, crowded).log10(node))], ["known", "value"])
        del table, node, n
        B.release()

    # whole sub-tries: nodes whose contexts end in the same two symbols, or three where two are crowded
    last_three = F.shiftright("node", BITS).bitwiseAND(F.lit(_mask(3)))
    sub_trie = F.when(last_two.isin(split), last_three).otherwise(last_two) if split else last_two
    dealt = counted.repartition(max(8, -(-2 * size // crowd)), sub_trie)
    return dealt.select("node", "n").mapInArrow(run, "known long, value double")


def score(docs: DataFrame, held_out: Column, order: int = ORDER, block_bytes: int = BLOCK) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) by a model of the rows that ``held_out`` leaves.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigram
    log10) and score (PPM log10), both over the whole lower-cased text and its end."""
    given = docs.select("doc_id", "text", held_out.alias("held_out"))
    texts, nodes, words = _blocks(given, order, block_bytes)
    counted = materialize(nodes.groupBy("node").agg(F.sum("n").alias("n")), "ppm_nodes")
    costs = materialize(node_costs(counted, order), "ppm_costs")
    discard(counted)
    # totals by combined aggregation; joined back, so that a word of every block is no group of one task
    totals = words.filter("n > 0").groupBy(F.col("word").alias("spelling")).agg(F.sum("n").alias("value"))
    totals = materialize(totals, "ppm_words")
    ends = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    total, kinds = totals.agg(F.coalesce(F.sum("value"), F.lit(0)), F.count(F.lit(1))).first()
    train_tokens, distinct = total + ends, kinds + (1 if ends else 0)
    unseen = -math.log10(train_tokens + distinct + 1)
    answers = nodes.select("block", "node").join(costs, F.col("node") == F.col("known"))
    answers = answers.select("block", "node", F.lit(None).cast("binary").alias("word"), "value")
    spoken = words.select("block", "word").join(totals, F.col("word") == F.col("spelling"))
    heard = spoken.select("block", F.lit(None).cast("long").alias("node"), "word", F.col("value").cast("double").alias("value"))

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        is_node = answers.column("node").is_valid()  # kept apart in Arrow: a null would turn the numbers into doubles
        node_rows, word_rows = answers.filter(is_node), answers.filter(answers.column("node").is_null())
        known, value = node_rows.column("node").to_numpy(), node_rows.column("value").to_numpy()
        order_ = np.argsort(known)
        known, value = known[order_], value[order_]
        heard_parts = []
        for batch in word_rows.select(["word", "value"]).combine_chunks().to_batches():
            for piece in B.slices(batch, "word", PIECE):
                data, offsets = B.buffers(piece.column("word"))
                hashes = [B.word_hashes(data, offsets[:-1], offsets[1:], k) for k in (0, 1)]
                heard_parts.append(Words(*hashes, piece.column("value").to_numpy(), pa.nulls(piece.num_rows, pa.binary())))
        vocabulary = Words.merged(heard_parts) if heard_parts else None
        del node_rows, word_rows, answers, heard_parts
        out = defaultdict(list)
        for blob in rows.column("texts").to_pylist():
            piece = pa.ipc.open_stream(blob).read_all().combine_chunks()
            data, offsets = B.buffers(piece.column("text"))
            node, at = windows(data, offsets, order)
            code, deepest = pd.factorize(node)
            out["score"].append(B.row_sums(value[_places(known, deepest)][code], at))
            start, end, first = B.words(data, offsets)
            c = np.zeros(len(start))
            if vocabulary is not None and len(start):
                c = vocabulary.lookup(*(B.word_hashes(data, start, end, k) for k in (0, 1)))
            tokens = np.diff(first) + 1
            out["n_tokens"].append(tokens)
            out["n_known"].append(B.row_sums((c > 0).astype(np.int64), first) + (1 if ends else 0))
            out["base_score"].append(B.row_sums(np.log10(c + 1), first) + math.log10(ends + 1) + unseen * tokens)
            out["doc_id"] += piece.column("doc_id").to_pylist()
            out["held_out"] += piece.column("held_out").to_pylist()
        B.release()
        numbers = {c: np.concatenate(out[c]) if out[c] else np.empty(0) for c in ("n_tokens", "n_known", "base_score", "score")}
        return pa.table({
            "doc_id": pa.array(out["doc_id"], id_type),
            "held_out": pa.array(out["held_out"], pa.bool_()),
            "n_tokens": pa.array(numbers["n_tokens"], pa.int64()),
            "n_known": pa.array(numbers["n_known"], pa.int64()),
            "train_tokens": pa.array([train_tokens] * len(out["doc_id"]), pa.int64()),
            "base_score": pa.array(numbers["base_score"], pa.float64()),
            "score": pa.array(numbers["score"], pa.float64()),
        })

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    replies = answers.unionByName(heard).withColumnRenamed("block", "of_block")
    return texts.select("block", "texts").groupBy("block").cogroup(replies.groupBy("of_block")).applyInArrow(run, schema)
