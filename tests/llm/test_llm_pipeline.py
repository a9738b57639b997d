"""The pipeline end to end: columns of any name pass through, stages follow what the parts say."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from eventweave.llm.shipping import ship
from eventweave.session import ensure_checkpoint_dir, materialize
from tests.conftest import SF001
from tests.llm import plain

CLASHES = ["shard", "slot", "size", "Shard_", "__range", "__index", "__g", "__at", "bytes", "component_id", "fingerprint", "text_md5", "rate", "copies", "taken",
           "target", "host", "node", "block", "word", "n", "value", "pick", "rn", "other_0", "votes", "posterior", "a b", "x.y"]


def stages(spark, docs, sf_dir):
    out = []
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"test_{name}")
        out.append(docs)
    return out


@pytest.fixture(scope="module")
def given(spark):
    ship(spark)
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="module")
def bare(spark, given):
    return stages(spark, given, SF001)


def test_columns_of_any_name_pass_through(spark, given, bare):
    wide = given.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASHES])
    added = {"size", "shard", "slot"}
    for plain_stage, stage in zip(bare, stages(spark, wide, SF001), strict=True):
        last = "slot" in plain_stage.columns
        assert set(stage.columns) == set(plain_stage.columns) | set(CLASHES)
        key = ["doc_id", *(["shard", "slot"] if last else [])]
        assert sorted(map(tuple, stage.select(*key).collect()), key=str) == sorted(map(tuple, plain_stage.select(*key).collect()), key=str)
        for c in CLASHES:
            if not (last and c in added):
                assert stage.filter(~F.col(f"`{c}`").eqNullSafe(F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")))).count() == 0, c


def test_an_empty_table_with_clashing_columns(spark, given):
    wide = given.limit(0).select("*", *[F.lit("x").alias(c) for c in CLASHES])
    assert [s.count() for s in stages(spark, wide, SF001)] == [0] * 5


def test_stages_follow_a_plain_version(spark, given, bare):
    """Texts, copies and slots through all stages against plain values."""
    text = {r["doc_id"]: r["text"] for r in given.collect()}
    kept = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in bare]
    quality, near, clean, mixed, sharded = kept
    assert quality <= set(text) and near <= quality and clean <= near and mixed <= clean and sharded == mixed
    # labels are never used in fitting: what they call low goes, what they call good stays
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in quality for i in good) >= 0.97 * len(good)
    # one document of each component stays
    components = plain.near_duplicates([(i, text[i]) for i in sorted(quality)])
    chosen = [components[i][1] for i in near]
    assert len(chosen) == len(set(chosen)) and set(chosen) == {c for _, c in components.values()}
    # documents that hold a benchmark item go
    items = [r["text"] for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    sets = [plain.shingles(t) for t in items]
    holds = lambda i: any(s and len(s & plain.shingles(text[i])) >= 0.8 * len(s) - 1e-9 for s in sets)
    assert clean == {i for i in near if not holds(i)}
    # repeats up to twice, the same text, and every source near its share
    copies = {}
    for r in bare[3].collect():
        assert r["text"] == text[r["doc_id"]]
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert max(copies.values()) <= 2
    # equal texts share a shard, slots run without a gap
    home, slots = {}, {}
    for r in bare[4].collect():
        assert home.setdefault(text[r["doc_id"]] or "", r["shard"]) == r["shard"]
        assert r["size"] == len((text[r["doc_id"]] or "").encode()) + 1
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    assert copies == {r["doc_id"]: r["n"] for r in bare[4].groupBy("doc_id").agg(F.count("*").alias("n")).collect()}


def test_stage_tables_are_released(spark, given):
    import os

    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    folders = lambda: {f for f in os.listdir(f"{root}/tables") if f.startswith("pipeline_")}
    before = folders()
    assert cp.run(spark, SF001).count() > 0
    assert {f.split("-")[0] for f in folders() - before} == {"pipeline_mixing"}
