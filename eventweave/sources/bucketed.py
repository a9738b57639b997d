"""Partitioned and bucketed tables: joins on the bucket key without a shuffle.

A table is a folder of parquet files (``<column>=<value>/`` folders, each row in the file of its
key's bucket, files sorted by the key) and an entry in the session's catalog that says so.
Spark reads bucket i of every such table in one task, so tables with the same key and
number of buckets join, group and deduplicate on the key where they lie, and a filter on the partition
column skips folders.  The folder outlives the catalog entry: :func:`open_bucketed` makes it anew.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def write_bucketed(
    df: DataFrame, folder: str, key: str, buckets: int, partition_by: str | None = None, table: str | None = None, mode: str = "overwrite"
) -> DataFrame:
    """Write ``df`` below ``folder``, bucketed and sorted by ``key``; the table read back.

    Rows are dealt out by the bucket's own hash first, so a folder holds one file a bucket.  A hot
    key is one bucket by definition: keys of published tables have few rows each."""
    spark, table = df.sparkSession, table or _new_name()
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")
    dealt = df.repartition(buckets, key)
    writer = dealt.write.mode(mode).format("parquet").option("path", folder).bucketBy(buckets, key).sortBy(key)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
    return spark.table(table)


def open_bucketed(
    spark: SparkSession, folder: str, schema: str, key: str, buckets: int, partition_by: str | None = None, table: str | None = None
) -> DataFrame:
    """The table that :func:`write_bucketed` left in ``folder``, in a session that doesn't know it.  ``schema`` lists
    all columns, the partition column included."""
    table = table or _new_name()
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")
    parted = f"PARTITIONED BY ({_quoted(partition_by)})" if partition_by else ""
    at = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {_quoted(table)} ({schema}) USING parquet {parted} "
        f"CLUSTERED BY ({_quoted(key)}) SORTED BY ({_quoted(key)}) INTO {int(buckets)} BUCKETS LOCATION '{at}'"
    )
    if partition_by:
        spark.sql(f"ALTER TABLE {_quoted(table)} RECOVER PARTITIONS")
    return spark.table(table)


def overwrite_partitions(name: str, folder: str, rows: DataFrame, key: str, buckets: int, partition_by: str, values: list[int | None]) -> None:
    """Put ``rows`` in place of the partitions ``values`` of the bucketed table ``name`` in ``folder``; every other
    partition keeps its files.  A partition that gets no rows loses its folder.  ``rows`` must not
    lie outside ``values``, and must not be read from the partitions they replace."""
    spark = rows.sparkSession
    kept = [r[0] for r in rows.select(partition_by).distinct().collect()]  # one row a partition
    if set(kept) - set(values):
        raise ValueError(f"rows outside the partitions to overwrite: {sorted(map(str, set(kept) - set(values)))}")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode, None)
    if kept:
        columns = [*[c for c in spark.table(name).columns if c != partition_by], partition_by]
        dealt = rows.select(*columns).repartition(buckets, key).sortWithinPartitions(partition_by, key)
        try:
            spark.conf.set(mode, "dynamic")
            dealt.write.mode("overwrite").insertInto(name)
        finally:
            spark.conf.unset(mode) if before is None else spark.conf.set(mode, before)
    for v in set(values) - set(kept):
        spark.sql(f"ALTER TABLE {_quoted(name)} DROP IF EXISTS PARTITION ({_quoted(partition_by)} = {'null' if v is None else int(v)})")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{partition_by}={'__HIVE_DEFAULT_PARTITION__' if v is None else int(v)}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)  # the table is external: its files stay otherwise
    spark.catalog.refreshTable(name)


def table_name(df: DataFrame) -> str:
    """The catalog name of a table that this module opened."""
    return re.search(r"bucketed_[0-9a-f]{12}", df._jdf.queryExecution().analyzed().toString()).group(0)


def forget(*tables: DataFrame) -> None:
    """Drop the catalog entries of bucketed tables; their files stay."""
    for df in tables:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {_quoted(table_name(df))}")


def rows_by_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """(bucket, rows): how evenly ``key`` fills the buckets."""
    bucket = F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")
    return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("n_rows"))


def _new_name() -> str:
    return f"bucketed_{uuid.uuid4().hex[:12]}"


def _quoted(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a plain name: {name!r}")
    return f"`{name}`"
