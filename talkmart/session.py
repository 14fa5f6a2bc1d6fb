"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time, also where the split costs one more
    # shuffle than the plan had.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "talkmart", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes under the paths, as the file system reports them; missing paths count 0."""
    total = 0
    for path in paths:
        root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(root):
            total += fs.getContentSummary(root).getLength()
    return total


#: More shuffle partitions than this are too many for one driver; beyond it partitions grow instead.
MAX_PARTITIONS = 20_000


@contextmanager
def sized_shuffles(
    spark: SparkSession, input_bytes: int, partition_bytes: int = 256 * 1024 * 1024
) -> Iterator[int]:
    """Shuffle partitions that suit the input, while the job runs; the old number afterwards.

    AQE joins partitions that turn out small, but it splits only skewed joins and
    rebalances, so a large input needs enough partitions from the start. Stored
    data counts four times, for what compression saves. The number is never below
    the configured one and never above ``MAX_PARTITIONS``.
    """
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(configured, min(MAX_PARTITIONS, ceil(4 * input_bytes / partition_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(configured))


@contextmanager
def removed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside go when it ends, for rows that are written whole and read from there."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package: functions that run there are sent by module name."""
    root = Path(__file__).resolve().parent
    if not root.is_dir():  # already inside an archive that was shipped
        return
    archive = Path(tempfile.mkdtemp(prefix="talkmart-")) / "talkmart.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, Path(root.name) / file.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
