"""Readers: raw JSON, Parquet staging, line lists, snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmart.schemas import RAW, STAGING


def read_raw_json(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = RAW,
    json_lines: bool = False,
) -> DataFrame:
    """Raw records from one or more paths or globs, with the schema given, never inferred.

    A value of the wrong type becomes NULL, so its row is rejected later. Array
    files cannot be split and are read by one task each; JSON Lines can be split.
    """
    return spark.read.schema(schema).option("multiLine", not json_lines).json(paths)


def read_per_source(spark: SparkSession, folder: str, name: str, sources: Sequence[str], **options) -> DataFrame:
    """The files ``<source>_<name>`` of several sources as one dataset."""
    return read_raw_json(spark, [f"{folder}/{source}_{name}" for source in sources], **options)


def read_json_lines(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(folder)


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Parquet, named columns only; the scan reads no others."""
    return spark.read.parquet(path).select(*columns)


def read_lines(spark: SparkSession, paths: str | Sequence[str], name: str = "target") -> DataFrame:
    """A list with one entry per line, stripped, empty lines left out."""
    lines = spark.read.text(paths).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias(name))
    return lines.filter(F.col(name) != "")


def read_failure_lists(spark: SparkSession, pattern: str, name: str = "target") -> DataFrame:
    """All failure lists that match the pattern, each entry once."""
    return read_lines(spark, pattern, name).distinct()


def register_staging(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Staging tables as temporary views ``staging_<name>`` for SQL users."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"staging_{name}")


def drop_staging(spark: SparkSession, names: Sequence[str] = tuple(STAGING)) -> None:
    for name in names:
        spark.catalog.dropTempView(f"staging_{name}")


def input_files(df: DataFrame) -> DataFrame:
    """The Parquet files behind a DataFrame with their row counts."""
    rows = df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"))
    files = rows.groupBy("file_path", "file_name").agg(F.count(F.lit(1)).alias("rows"))
    return files.filter(F.col("file_name").endswith(".parquet"))


def snapshot_ids(spark: SparkSession, base: str) -> list[str]:
    """Ids of the complete snapshots under ``base``, oldest first."""
    return _snapshots(spark, base, complete=True)


def _snapshots(spark: SparkSession, base: str, complete: bool) -> list[str]:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        path = status.getPath()
        done = fs.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))
        if path.getName().startswith("snapshot=") and (done or not complete):
            found.append(path.getName().removeprefix("snapshot="))
    return sorted(found)


def all_snapshot_ids(spark: SparkSession, base: str) -> list[str]:
    """Ids of all snapshots under ``base``, unfinished ones included."""
    return _snapshots(spark, base, complete=False)


def next_snapshot_id(spark: SparkSession, base: str) -> str:
    """A version number above all that are there, complete or not."""
    taken = [int(i) for i in all_snapshot_ids(spark, base) if i.isdigit()]
    return f"{max(taken, default=0) + 1:010d}"


def read_snapshot(spark: SparkSession, base: str, schema: T.StructType, before: str | None = None) -> DataFrame:
    """The newest complete snapshot, or the newest one older than ``before``; empty if none.

    Columns of ``schema`` that a snapshot does not have are NULL, others of its own are not read.
    """
    ids = [i for i in snapshot_ids(spark, base) if before is None or i < before]
    if not ids:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{base}/snapshot={ids[-1]}")
