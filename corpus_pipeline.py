"""The corpus pipeline: quality, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and reread as the next one's ``docs``; all but the last return the columns of
``documents``.  Every stage works on all rows that its predecessor kept:

1. ``quality``: the weak-label classifier is fitted on the stage's own input; rejected documents go.
2. ``near_duplicates``: one document of each SimHash component stays.
3. ``decontamination``: documents that contain a benchmark item go.
4. ``mixing``: every document is repeated as often as its source's target asks (0 to 2 times).
5. ``sharding``: rows get their shard and slot; equal texts share a shard.

An empty table passes through all stages.  SQL cannot express the fitted and iterative
stages, so ``ORACLE_SQL`` is None and the tests hold the pipeline against a plain version.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.llm import bfd_shards, containment, entropy_mix, simhash_trie, weak_quality
from eventweave.llm.shipping import ship
from eventweave.session import discard, materialize

ORACLE_SQL = None
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keeps_other_columns(stage: Callable) -> Callable:
    """A stage that sees the columns of ``documents`` under their names and any others under
    neutral ones, so that no name a stage works with can clash; they come back as they were."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in COLUMNS]
        aside = {c: f"other_{i}" for i, c in enumerate(others)}
        out = stage(spark, docs.select(*[F.col(f"`{c}`").alias(aside.get(c, c)) for c in docs.columns]), sf_dir)
        back = {v: k for k, v in aside.items()}
        added = {c.lower() for c in out.columns if c not in back}
        # a column that the stage adds takes the place of one of its name
        return out.select(*[F.col(c).alias(back.get(c, c)) for c in out.columns if back.get(c, "").lower() not in added])

    return run_stage


@keeps_other_columns
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return weak_quality.accepted(docs, weak_quality.fit(docs))


@keeps_other_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash_trie.one_of_each(docs)


@keeps_other_columns
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return containment.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@keeps_other_columns
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return entropy_mix.mix(docs)


@keeps_other_columns
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    added = ["size", "shard", "slot"]  # in place of columns of these names
    return bfd_shards.pack(bfd_shards.text_columns(docs)).select(*[c for c in docs.columns if c not in added], *added)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a written table, released once the next is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written = None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
        if written is not None:
            discard(written)
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
