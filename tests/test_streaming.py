"""Streaming ingest picks up each file once, across restarts."""

import tempfile

from eventweave.plans.q_cleaning import declarations_raw
from eventweave.streaming import ingest_declarations

from tests.conftest import SF001


def test_ingest_is_incremental(spark):
    raw = declarations_raw(spark, SF001)
    src, out, ck = tempfile.mkdtemp(), tempfile.mkdtemp(), tempfile.mkdtemp()
    a, b = raw.filter("incidentType < '3'"), raw.filter("incidentType >= '3'")
    a.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{src}/part-a")
    ingest_declarations(spark, f"{src}/*", out, checkpoint=ck)
    n1 = spark.read.parquet(out).count()
    b.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{src}/part-b")
    ingest_declarations(spark, f"{src}/*", out, checkpoint=ck)
    n2 = spark.read.parquet(out).count()
    ingest_declarations(spark, f"{src}/*", out, checkpoint=ck)
    assert spark.read.parquet(out).count() == n2 > n1 > 0


def test_a_repeated_batch_is_in_the_table_once(spark):
    """A crash after the table's files are written but before the stream's commit repeats the batch."""
    import glob
    import os

    raw = declarations_raw(spark, SF001)
    src, out, ck = tempfile.mkdtemp(), tempfile.mkdtemp(), tempfile.mkdtemp()
    raw.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{src}/part-a")
    ingest_declarations(spark, f"{src}/*", out, checkpoint=ck)
    n = spark.read.parquet(out).count()
    for f in glob.glob(f"{ck}/commits/*") + glob.glob(f"{ck}/commits/.*crc"):
        os.remove(f)
    ingest_declarations(spark, f"{src}/*", out, checkpoint=ck)
    assert spark.read.parquet(out).count() == n > 0
