"""Retry cycles at data level: what is still to do, and which attempt counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pending(attempted: DataFrame, succeeded: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Attempted items without a success, each once."""
    keys = [key] if isinstance(key, str) else list(key)
    return attempted.select(*keys).distinct().join(succeeded.select(*keys), keys, "left_anti")


def _stripped(entries: DataFrame) -> Column:
    """The first column without white space around it, as the line readers have it."""
    return F.regexp_replace(F.col(entries.columns[0]), r"^\s+|\s+$", "")


def merged_failures(*failed_lists: DataFrame) -> DataFrame:
    """All failure lists as one, stripped, each entry once."""
    merged = failed_lists[0].select(_stripped(failed_lists[0]).alias("target"))
    for more in failed_lists[1:]:
        merged = merged.unionByName(more.select(_stripped(more).alias("target")))
    return merged.filter(F.col("target") != "").distinct()


def latest_attempt(attempts: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key over all attempts: the first in ``order``."""
    ranked = attempts.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")
