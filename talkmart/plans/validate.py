"""Checks between the stages: raw JSON before the text job, stage tables before the load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmart.operators import quality
from talkmart.schemas import RAW, STAGE_PARTITIONS, STAGING_DIRS


def raw_values(spark: SparkSession, paths: str | Sequence[str], json_lines: bool = False) -> DataFrame:
    """Every raw record as it is written, with its file and its place in the file's array.

    Text that is no JSON, or no array, gives one row with a NULL record.
    """
    text = spark.read.text(paths, wholetext=not json_lines).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )
    if json_lines:
        return text.select("file", F.lit(0).alias("pos"), F.try_parse_json("value").alias("record"))
    records = F.from_json("value", "array<variant>")
    return text.select("file", F.posexplode_outer(records).alias("pos", "record"))


def raw_violations(spark: SparkSession, paths: str | Sequence[str], json_lines: bool = False) -> DataFrame:
    """Missing keys and wrong types in raw files; every record of every file is checked."""
    return quality.json_violations(raw_values(spark, paths, json_lines), "record", RAW, ["file", "pos"])


def stage_differences(spark: SparkSession, base: str) -> DataFrame:
    """Columns of the four stage tables that differ from their declarations."""
    partitions = STAGE_PARTITIONS.fieldNames()
    found, expected = {}, {}
    for name, (folder, schema) in STAGING_DIRS.items():
        extra = [c for c in partitions if c not in schema.fieldNames()]
        df = spark.read.parquet(f"{base}/{folder}").drop(*extra)
        found[name], expected[name] = df, schema
    return quality.schema_report(spark, found, expected)
