"""What one task holds does not grow with the input."""

from __future__ import annotations

from eventweave.plans import published as pb
from eventweave.plans import q_published
from eventweave.session import RUNTIME_CONF, tune


def test_buckets_follow_the_rows(spark, tmp_path, monkeypatch):
    assert pb.buckets_for_rows(0, 8) == 8 and pb.buckets_for_rows(270_000_000, 8) == 258
    for name, n in (("lineitem", 900), ("orders", 300)):
        spark.range(n).selectExpr(f"id AS {name[0]}_orderkey").write.parquet(f"{tmp_path}/{name}.parquet")
    assert q_published.star_buckets(spark, str(tmp_path)) == 8
    monkeypatch.setattr(pb, "BUCKET_ROWS", 100)
    assert q_published.star_buckets(spark, str(tmp_path)) == 12


def test_shuffle_partitions_stay_small(spark):
    tune(spark)
    assert RUNTIME_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "32MB"
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32MB"
