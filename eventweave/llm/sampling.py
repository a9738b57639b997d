"""Bounded samples of distinct rows, the same whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: share of the distinct rows taken beyond the bound before it is applied, for the error of their estimated number
MARGIN = 1.2


def distinct_sample(rows: DataFrame, most: int, name: str) -> DataFrame:
    """At most ``most`` distinct rows of ``rows``, those of the smallest ``pick`` (a hash of
    all columns, added), written once.  Repeated rows are one row of the sample."""
    pick = F.xxhash64(*rows.columns)
    n = rows.agg(F.approx_count_distinct(pick, 0.02)).first()[0]
    chosen = rows.withColumn("pick", pick)
    if n > MARGIN * most:
        chosen = chosen.filter(F.col("pick") < int(MARGIN * most / n * 2.0**64) - 2**63)
    chosen = materialize(chosen.dropDuplicates(["pick"]), name)
    # about MARGIN * most hashes, whatever the table's size
    border = chosen.select("pick").orderBy("pick").limit(most).agg(F.max("pick")).first()[0]
    return chosen if border is None else chosen.filter(F.col("pick") <= border)
