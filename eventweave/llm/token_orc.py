"""Token ids as ORC files (operator 11).

``write_tokens`` encodes every whole text with a public tokenizer, ends each document with
``end_id`` and writes one row a document in ascending ``doc_id`` order:
``file_no, doc_id, start, n_tokens, ids``.  The ids are an ``array<int>`` column, which ORC
stores as run-length encoded integers; files are cut into stripes of ``stripe_bytes``, each with a row index
every ``index_rows`` rows and a Bloom filter on ``doc_id``.  ``read_tokens`` reads the files, one
task to a run of stripes; ``lookup`` fetches documents by id, skipping files and stripes by
their smallest and largest id and row groups by the Bloom filter.  ``file_table`` lists the files with
their first and last id, documents and tokens, from the narrow columns alone.

Rows are range-partitioned on (doc_id, hash of the text, position in the input) and each range is
one file, so the files follow each other in order and equal ids do not pile up in one task.
``start`` inside a file counts from 0; the number of tokens in all earlier files comes from a
running sum over one row a file (``with_start``).

Encoding works on distinct pieces: the tokenizer's rules never join characters
across white space, so a text's ids are those of its pieces one after another.  The pieces of a slice of
texts are made distinct in Arrow, unseen ones are encoded, and the ids are laid out by numpy; a
worker keeps about ``KEPT_PIECES`` pieces.  A tokenizer whose rules do look across white space is given whole
texts (``by_word=False``).

Edge cases: a null or empty text is the end id alone; null ids come first; rows that share an id are
ordered by a hash of their texts, and repeated rows each keep their row; texts of any length are
encoded whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import bytesops as B

END_ID = 2
TOKENIZER = "word_bpe_49k.json"
STRIPE_BYTES = 64 << 20
INDEX_ROWS = 1_000
FALSE_POSITIVES = 0.01
#: text encoded at once; more repeats of a word meet in a longer slice
SLICE_BYTES = 8 << 20
#: distinct pieces whose ids a worker keeps between slices (about 40 bytes each)
KEPT_PIECES = 1 << 20
#: words encoded in one call of the tokenizer
JOINED = 512

SCHEMA = "file_no int, doc_id long, start long, n_tokens long, ids array<int>"
_ROW = pa.schema([("file_no", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


def tokenizer_file(name: str = TOKENIZER) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(*chars: range) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    for some in chars:
        found[some] = True
    return found


_LETTER = _table(range(65, 91), range(97, 123))
_SMALL = _table(range(97, 123))
_DIGIT = _table(range(48, 58))
#: ASCII signs but the apostrophe, which may begin a contraction
_SIGN = _table(range(33, 39), range(40, 48), range(58, 65), range(91, 97), range(123, 127))


class Encoder:
    """Ids of texts, through the ids of their distinct pieces.

    A piece is what stands between white space, or between two neighbouring ASCII characters of which one is a
    digit, or one a letter and the other a sign: the rules of the tokenizer always end a word there.  ASCII capitals
    are made small beforehand (but before a character that could combine with one).  Where a text may hold a
    special token, pieces are the runs between white space as they are."""

    def __init__(self, name: str, by_word: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file(name))
        self.by_word = by_word
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        # kept pieces: two hashes in order of the first, and the place of their ids
        self.hash, self.check, self.place = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        self.ids, self.first = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number by text) of texts on their own."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(count.sum())), count

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of small ASCII letters, of which each ends with its one word-ending token."""
        lines = [" ".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        ids, _ = self._each(lines)
        ends = np.flatnonzero(self.ends_word[ids])
        if len(ends) != len(words):  # a vocabulary without word ends
            return self._each(words)
        return ids, np.diff(ends, prepend=-1)

    def _encode(self, pieces: pa.Array, simple: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number by piece), the simple pieces first."""
        a = self._joined(pieces.filter(pa.array(simple)).to_pylist())
        b = self._each(pieces.filter(pa.array(~simple)).to_pylist())
        return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """The places of distinct ``pieces`` in the kept table, after encoding new ones."""
        if len(self.hash) > KEPT_PIECES:
            self._forget()
        data, offsets = B.buffers(pieces)
        one, two = (B.word_hashes(data, offsets[:-1], offsets[1:], which) for which in (0, 1))
        at = np.searchsorted(self.hash, one)
        known = at < len(self.hash)
        known[known] = (self.hash[at[known]] == one[known]) & (self.check[at[known]] == two[known])
        place = np.empty(len(one), dtype=np.int64)
        place[known] = self.place[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            simple = B.row_sums((~_SMALL[data]).astype(np.int64), offsets)[new] == 0
            ids, count = self._encode(pieces.take(pa.array(new)), simple)
            place[new[np.argsort(~simple, kind="stable")]] = len(self.first) - 1 + np.arange(len(new))
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(count)])
            self.ids = np.concatenate([self.ids, ids])
            order = new[np.argsort(one[new], kind="stable")]
            into = np.searchsorted(self.hash, one[order])
            self.hash, self.check = np.insert(self.hash, into, one[order]), np.insert(self.check, into, two[order])
            self.place = np.insert(self.place, into, place[order])
        return place

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids of each text) of a string column; a null has none."""
        if not self.by_word:
            return self._each([t or "" for t in column.to_pylist()])
        data, offsets = B.buffers(column)
        start, end, _ = B.words(data, offsets)
        if len(start) == 0:
            return np.empty(0, dtype=np.int32), np.zeros(len(offsets) - 1, dtype=np.int64)
        begins, ends = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
        begins[start], ends[end - 1] = True, True
        if b"<|" not in data.tobytes():
            letter, digit, sign = _LETTER[data], _DIGIT[data], _SIGN[data]
            plain = letter | digit | sign
            cut = (digit[1:] & plain[:-1]) | (plain[1:] & digit[:-1]) | (letter[1:] & sign[:-1]) | (sign[1:] & letter[:-1])
            begins[1:] |= cut
            ends[:-1] |= cut
            small = B.LOWER[data]
            np.copyto(small[:-1], data[:-1], where=data[1:] >= 0x80)
            data = small
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        first = np.searchsorted(start, offsets)
        border = np.zeros(len(start) + 1, dtype=np.int64)
        np.cumsum(end - start, out=border[1:])
        packed = pa.py_buffer(data[~B.SPACE[data]])
        pieces = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(border), packed).dictionary_encode()
        place = self._places(pieces.dictionary)[pieces.indices.to_numpy()]
        count = (self.first[1:] - self.first[:-1])[place]
        begin = np.zeros(len(place) + 1, dtype=np.int64)
        np.cumsum(count, out=begin[1:])
        at = np.repeat(self.first[place] - begin[:-1], count)
        at += np.arange(begin[-1])
        return self.ids[at], begin[first[1:]] - begin[first[:-1]]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(name: str, by_word: bool = True) -> Encoder:
    """This worker's encoder: a Python worker serves many tasks, and what it knows of pieces serves them all."""
    if (name, by_word) not in _ENCODERS:
        _ENCODERS[name, by_word] = Encoder(name, by_word)
    return _ENCODERS[name, by_word]


def _encoded(name: str, end_id: int, by_word: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, position = encoder(name, by_word), 0
        for batch in batches:
            for part in B.slices(batch, "text", SLICE_BYTES):
                ids, count = known.texts(part.column("text"))
                ends = np.cumsum(count + 1)  # with each document's end id
                with_end = np.full(int(ends[-1]), end_id, dtype=np.int32)
                inside = np.ones(len(with_end), dtype=bool)
                inside[ends - 1] = False
                with_end[inside] = ids
                offsets = np.concatenate([[0], ends])
                rows = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(with_end, pa.int32()))
                start = pa.array(position + offsets[:-1], pa.int64())
                position += int(ends[-1])
                columns = [part.column("file_no"), part.column("doc_id"), start, pa.array(count + 1, pa.int64()), rows]
                yield pa.RecordBatch.from_arrays(columns, schema=_ROW)
        B.release()

    return encode


def token_folder(spark: SparkSession) -> str:
    """A new folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/tokens-{uuid.uuid4().hex[:8]}"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    stripe_bytes: int = STRIPE_BYTES,
    index_rows: int = INDEX_ROWS,
    files: int | None = None,
    by_word: bool = True,
) -> None:
    """Write the token ids of ``docs(doc_id, text)`` as ORC files below ``path``.

    ``files``: the number of ranges; by default Spark's number of shuffle partitions, joined
    up to its advisory size."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # rows equal in id and text are interchangeable, so their position may part them
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("seen", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("seen")]
    ranges = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    ranges = ranges.sortWithinPartitions(*order).select(F.spark_partition_id().alias("file_no"), "doc_id", "text")
    encoded = ranges.mapInArrow(_encoded(tokenizer, end_id, by_word), SCHEMA)
    writer = encoded.write.mode("overwrite").option("compression", "zstd")
    writer = writer.option("orc.stripe.size", stripe_bytes).option("orc.create.index", "true").option("orc.row.index.stride", index_rows)
    writer.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", FALSE_POSITIVES).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows: file_no, doc_id, start (in its file), n_tokens, ids."""
    return spark.read.schema(SCHEMA).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of the listed documents; the list reaches the files' statistics and Bloom filters."""
    return read_tokens(spark, path).filter(F.col("doc_id").isin(doc_ids))


def file_table(spark: SparkSession, path: str) -> DataFrame:
    """One row a file: file_no, first and last id, documents, tokens and the tokens before it."""
    per_file = read_tokens(spark, path).groupBy("file_no").agg(
        F.min("doc_id").alias("first_id"),
        F.max("doc_id").alias("last_id"),
        F.count(F.lit(1)).alias("documents"),
        F.sum("n_tokens").alias("tokens"),
    )
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return per_file.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def with_start(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` with ``start`` counted over all files."""
    return rows.join(files.select("file_no", "before"), "file_no").withColumn("start", F.col("start") + F.col("before")).drop("before")


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("ids")
        ids = column.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)).tolist()
        view = memoryview(ids.tobytes())
        crc = [zlib.crc32(view[4 * a : 4 * z]) for a, z in zip([0, *ends[:-1]], ends, strict=True)]
        kept = [batch.column(c) for c in ("file_no", "doc_id", "start")]
        lengths = pa.array(np.diff([0, *ends]), pa.int64())
        yield pa.RecordBatch.from_arrays([*kept, lengths, pa.array(crc, pa.int64())], names=["file_no", "doc_id", "start", "n_tokens", "ids_crc32"])


def checksums(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`read_tokens` with the ids replaced by their number and their unsigned
    crc32 (as little-endian unsigned 32-bit integers)."""
    return rows.select("file_no", "doc_id", "start", "ids").mapInArrow(_checked, "file_no int, doc_id long, start long, n_tokens long, ids_crc32 long")
