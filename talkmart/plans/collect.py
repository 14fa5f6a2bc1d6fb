"""Collection on stored data: pages to raw records, failure lists, second pass."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from talkmart.operators import pages, recovery
from talkmart.sources.readers import read_failure_lists
from talkmart.sources.writers import write_json_lines, write_lines

Extract = Callable[[DataFrame], DataFrame]


def collect_pages(
    spark: SparkSession, stored: DataFrame, extract: Extract, out: str, day: str | date, name: str
) -> None:
    """One pass over stored pages: raw records of the day, and the links that failed.

    ``extract`` is one of the page extractors with its car and source bound.
    Records go to ``raw/dt=<day>/<name>`` as JSON Lines, failures to
    ``target/dt=<day>/<name>_failed``. The extraction is written once and both
    outputs are read from it.
    """
    once = f"{out}/extracted/dt={day}/{name}"
    extract(stored).write.mode("overwrite").parquet(once)
    extracted = spark.read.parquet(once)
    write_json_lines(pages.usable(extracted), f"{out}/raw/dt={day}/{name}")
    write_lines(pages.to_retry(extracted), f"{out}/target/dt={day}/{name}_failed", "url")


def retry_pages(
    spark: SparkSession, stored: DataFrame, extract: Extract, out: str, day: str | date, name: str
) -> None:
    """Second pass over the links on all failure lists of ``name``.

    Its records land next to those of the first pass, so the daily read takes both.
    """
    failed = read_failure_lists(spark, f"{out}/target/dt={day}/{name}_failed*", "url")
    again = stored.join(failed, "url", "left_semi")
    collect_pages(spark, again, extract, out, day, f"{name}_recovery")


def still_missing(spark: SparkSession, out: str, day: str | date, name: str) -> DataFrame:
    """Links that failed in the first pass and were not recovered in the second."""
    first = spark.read.parquet(f"{out}/extracted/dt={day}/{name}")
    second = spark.read.parquet(f"{out}/extracted/dt={day}/{name}_recovery").filter("status = 'ok'")
    return recovery.pending(pages.to_retry(first), second, "url")
