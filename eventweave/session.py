"""Session settings and lineage cuts.

The library never creates a cluster session for the caller; it only tunes SQL
settings that are safe to change at runtime (AQE, skew join, time zone).  The
checkpoint folder always comes from ``spark.checkpoint.dir``; a private temporary
folder is only used when it is unset on a ``local`` master (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join partition counts as skewed at 4x the median size (and above the
    # skewedPartitionThresholdInBytes floor), a little stricter than the default
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # AQE converts a sort-merge join to a broadcast join only after the build
    # side's shuffle stage has run and measured below this size: the size check
    # behind every data-derived broadcast in this library.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # shuffle partitions are coalesced (or skew-split) towards this size.  Sorted or hashed rows take up to ten
    # times their compressed size: 32 MB keep a task's memory near 300 MB however large the input is
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    # scan splits: only the projected columns of a split are decoded, so a
    # 256 MB file split stays well inside a task's memory
    "spark.sql.files.maxPartitionBytes": "256MB",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators are written for."""
    for k, v in RUNTIME_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked setting on a managed cluster
            pass
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "eventweave") -> SparkSession:
    """Session for tests and the local benchmark (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, which every executor must be able to
    read: ``spark.checkpoint.dir`` of the session.  Only a ``local`` master may
    leave it unset (tests); it then gets a private temporary folder."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not _single_machine(sc.master):
        raise ValueError(
            f"spark.checkpoint.dir is not set and the master is {sc.master!r}: name a folder shared by all executors"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="eventweave-ckpt-"))
    return sc.getCheckpointDir()


def _single_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut the lineage at a pipeline stage: write the frame once as a parquet
    table in the shared checkpoint folder and continue from the files.

    Unlike ``Dataset.checkpoint`` (which evaluates the plan once to count and
    again to save the RDD) this computes the stage once; later reads prune
    columns and push filters into the files, and a lost executor only re-reads
    files instead of recomputing the stage."""
    return materialize(df, name)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Used between pipeline stages (spans, event map, keys) the way the reference
    saves files between scripts; the written table is also a restart point.
    ``compression``: the files' codec where the session's own isn't wanted.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tables/{name}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*stages: DataFrame) -> None:
    """Delete stage tables made by :func:`materialize` that nothing reads any more."""
    for df in stages:
        spark = df.sparkSession
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        root = ensure_checkpoint_dir(spark).rstrip("/")
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            if "/tables/" in folder and root.split(":", 1)[-1].lstrip("/") in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)
