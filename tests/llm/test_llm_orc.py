"""Token ids in ORC files: ids, order, offsets, stripes and pruning."""

import glob
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.orc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventweave.llm import token_orc
from eventweave.llm.shipping import ship
from tests.conftest import SF001

_whole = {}


def whole(texts):
    """Ids of whole texts by the library alone."""
    if not _whole:
        from tokenizers import Tokenizer

        _whole["t"] = Tokenizer.from_file(token_orc.tokenizer_file())
    return [e.ids for e in _whole["t"].encode_batch([t or "" for t in texts], add_special_tokens=False)]


def brute(rows):
    """(doc_id, start, n_tokens, crc) of (doc_id, text) rows in the order given."""
    out, start = [], 0
    for (i, _), ids in zip(rows, whole([t for _, t in rows]), strict=True):
        ids = [*ids, token_orc.END_ID]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, docs, **how):
    folder = token_orc.token_folder(ship(spark))
    token_orc.write_tokens(docs, folder, **how)
    found = token_orc.with_start(token_orc.checksums(token_orc.read_tokens(spark, folder)), token_orc.file_table(spark, folder))
    return folder, [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in found.orderBy("start").collect()]


ODD = ["J̌H̱T̈W̊Y̊ ǰ", "a,b.c'd'S 'll!'s a≮b ≠1 12345x6_7 1⃣ é,É ,é …,a", "x<|ENDOFTEXT|> A<|endoftext|>B", "Kelvin K Å ſt", " \t\n\x0b\x0c\r ", "I'll DON'T 'tis 12,5  x y", "é ́a ẛ̣ İIı ΑΣ ΣΑ", "<|endoftext|> a<|startoftext|>b", "日本語 안녕 \U0001f600️", "\x00\x01 \x1c\x85"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=60), st.text(alphabet="aBJ'sT \n\u030c\u0308.,<|\u00e91\u2082\u0338", max_size=60), st.none()), max_size=8))
def test_ids_by_word_are_those_of_whole_texts(texts):
    encoder = token_orc.Encoder(token_orc.TOKENIZER)
    for _ in range(2):  # with and without kept words
        ids, count = encoder.texts(pa.array(texts, pa.string()))
        assert np.split(ids, np.cumsum(count)[:-1])[0].tolist() == whole(texts)[0] if texts else len(ids) == 0
        assert ids.tolist() == [i for one in whole(texts) for i in one] and count.tolist() == [len(x) for x in whole(texts)]


def test_kept_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(token_orc, "KEPT_PIECES", 5)
    encoder = token_orc.Encoder(token_orc.TOKENIZER)
    for n in range(30):
        texts = [f"word{chr(97 + n % 26)} other{chr(97 + n % 7)} third", None]
        ids, _ = encoder.texts(pa.array(texts, pa.string()))
        assert ids.tolist() == whole(texts)[0]
        assert len(encoder.place) <= 5 + 3 and (np.diff(encoder.hash.astype(float)) > 0).all()


@pytest.mark.parametrize("files", [None, 7])
def test_given_documents_round_trip(spark, files):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    folder, found = written(spark, docs.repartition(5), files=files)
    assert found == brute(rows)
    if files:
        assert token_orc.file_table(spark, folder).count() == files
    spans = sorted((r["first_id"], r["last_id"]) for r in token_orc.file_table(spark, folder).collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_nulls_ties_long_texts_and_other_columns(spark):
    rows = [(3, "b a"), (3, "b a"), (3, "a"), (None, "x"), (None, None), (5, "word " * 60_000), (4, ""), (4, None), (1, "q" * 200_000)] + [(9, o) for o in ODD]
    docs = spark.createDataFrame([(i, t, 0, 1, 2, "x") for i, t in rows], "doc_id long, text string, file_no int, start long, seen int, hash string")
    _, found = written(spark, docs)
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(t)
    assert [f[0] for f in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    expected = {}
    for i, texts in ids.items():
        expected[i] = sorted((n, c) for t in texts for _, _, n, c in brute([(i, t)]))
    got = {}
    for i, _, n, c in found:
        got.setdefault(i, []).append((n, c))
    assert {i: sorted(v) for i, v in got.items()} == expected
    assert [f[1] for f in found] == [0, *np.cumsum([f[2] for f in found])[:-1]]
    assert written(spark, docs.limit(0))[1] == []


def test_equal_ids_spread_over_files(spark):
    docs = spark.range(4000).select(F.lit(7).alias("doc_id"), F.lit("the same text").alias("text"))
    folder, found = written(spark, docs, files=8)
    assert token_orc.file_table(spark, folder).agg(F.max("documents")).first()[0] < 1200
    n = len(whole(["the same text"])[0]) + 1
    assert [f[1] for f in found] == [n * i for i in range(4000)]


def _rows_scanned(df):
    """Rows that the file scan of ``df`` hands on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan.metrics().apply("numOutputRows").value()


def test_stripes_are_read_in_parallel_and_pruned(spark):
    docs = spark.range(60_000).select((F.col("id") * 2).alias("doc_id"), F.concat_ws(" ", F.lit("text"), F.md5(F.col("id").cast("string"))).alias("text"))
    folder, _ = written(spark, docs, files=1, stripe_bytes=200_000)
    (file,) = glob.glob(f"{folder.removeprefix('file:')}/*.orc")
    orc = pa.orc.ORCFile(file)
    assert orc.nstripes >= 4 and orc.row_index_stride == token_orc.INDEX_ROWS and orc.compression == "ZSTD"
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "400000")
        per_task = token_orc.read_tokens(spark, folder).groupBy(F.spark_partition_id()).count().collect()
        assert len(per_task) >= 3 and sum(r["count"] for r in per_task) == 60_000
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        one = token_orc.lookup(spark, folder, [70_000])
        assert [r["n_tokens"] for r in one.collect()] == [len(r["ids"]) for r in one.collect()] and one.count() == 1
        assert 0 < _rows_scanned(one) <= 2 * token_orc.INDEX_ROWS  # row index: not the whole stripe
        # odd ids lie between the smallest and largest of every row group: only the Bloom filter can skip them
        absent = [_rows_scanned(token_orc.lookup(spark, folder, [i])) for i in range(10_001, 110_001, 10_000)]
        assert sum(n == 0 for n in absent) >= 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept[0])
        spark.conf.set("spark.sql.adaptive.enabled", kept[1])
