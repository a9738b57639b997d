"""Readers and writers.  Every read carries an explicit schema so that nothing is
inferred from a sample and column pruning / predicate pushdown reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from ..session import materialize
from .schemas import DRIVER_SCHEMAS, RAW_SCHEMAS


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read ``{root}/{name}.parquet`` with its declared schema."""
    schema = DRIVER_SCHEMAS.get(name) or RAW_SCHEMAS.get(name)
    return read_parquet(spark, f"{root.rstrip('/')}/{name}.parquet", schema)


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True, skip_lines: int = 0) -> DataFrame:
    """CSV with a given schema; malformed fields become NULL rather than failing the job.

    ``skip_lines``: banner lines above the header of every file.  They are in a file's first
    split, whose lines are compared with its first; quoted line breaks are not supported then."""
    if not skip_lines:
        return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)
    lines = _lines(spark, path)
    first = lines.filter("start = 0").groupBy(F.col("file").alias("of")).agg(F.min("m").alias("top"))
    top = lines.filter("start = 0").join(first, F.col("file") == F.col("of")).filter(F.col("m") - F.col("top") >= skip_lines + int(header))
    body = top.select("value").unionByName(lines.filter("start > 0").select("value"))
    return body.filter("value != ''").select(F.from_csv("value", schema, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the files with its file, the start of its split and a number ``m``.  A split is read by
    one task in order, so ``m`` counts a split's lines from its smallest without a shuffle."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    return spark.read.text(path).select("value", *place, F.monotonically_increasing_id().alias("m"))


def read_csv_checked(spark: SparkSession, path: str, schema: str, rejects: str, header: bool = True, skip_lines: int = 0) -> DataFrame:
    """CSV with a given schema whose malformed lines go to a table instead of turning NULL.

    A line with a field that doesn't parse, or too few or too many fields, is appended to the
    parquet table at ``rejects`` as (file, line, value), ``line`` counted from 1 in its file; the result holds
    all other lines.  Files whose header doesn't name the schema's columns in order (case and outer
    blanks aside) raise ValueError before anything is written.  Blank lines and the ``skip_lines`` banner lines of every file
    are no rows; a file without lines, or no more than the banner, has no rows and no header to check.
    Quoted line breaks are not supported: lines are split before they are parsed.

    Lines are numbered from one small table of splits (lines and smallest number of each); only rejected
    lines and the lines of first splits are joined with it."""
    lines = _lines(spark, path)
    splits = materialize(lines.groupBy("file", "start").agg(F.min("m").alias("top"), F.count(F.lit(1)).alias("n")), "csv_splits")
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select(F.col("file").alias("of"), F.col("start").alias("at"), "top", F.coalesce(before, F.lit(0)).alias("before"))
    banner = skip_lines + int(header)
    place = (F.col("file") == F.col("of")) & (F.col("start") == F.col("at"))
    first = lines.filter("start = 0").join(splits, place).withColumn("line", F.col("m") - F.col("top") + 1)
    if header:
        _check_header(first.filter(F.col("line") == banner), schema)
    top = first.filter(F.col("line") > banner) if banner else first
    body = top.select("file", "start", "m", "value").unionByName(lines.filter("start > 0").select("file", "start", "m", "value"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}
    parsed = body.filter(F.trim("value") != "").withColumn("r", F.from_csv("value", f"{schema}, __bad STRING", options))
    bad = F.col("r.__bad").isNotNull()
    rejected = parsed.filter(bad).select("file", "start", "m", "value").join(splits, place)
    rejected = rejected.select("file", (F.col("before") + F.col("m") - F.col("top") + 1).alias("line"), "value")
    write_parquet(rejected, rejects, mode="append")
    return parsed.filter(~bad).select("r.*").drop("__bad")


def _check_header(headers: DataFrame, schema: str) -> None:
    names = [f.name for f in _parse_datatype_string(schema).fields]
    given = F.from_csv("value", ", ".join(f"c{i} STRING" for i in range(len(names) + 1)), {"mode": "PERMISSIVE"})
    same = given[f"c{len(names)}"].isNull()  # no further name
    for i, name in enumerate(names):
        same = same & F.lower(F.trim(F.coalesce(given[f"c{i}"], F.lit("")))).eqNullSafe(name.strip().lower())
    wrong = headers.filter(~same).select("file", "value").limit(10).collect()
    if wrong:
        found = "; ".join(f"{r['file']}: {r['value'][:200]}" for r in wrong)
        raise ValueError(f"header is not {', '.join(names)} in {found}")


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)
