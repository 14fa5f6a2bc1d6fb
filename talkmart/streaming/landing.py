"""Incremental landing: each raw file that arrives is taken up once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from talkmart.operators.quarantine import with_reject_reasons
from talkmart.schemas import RAW


def raw_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """JSON Lines files under ``folder`` as a stream of raw records."""
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", max_files).json(folder)


def land_stream(raw: DataFrame, out: str, checkpoint: str, day: str) -> StreamingQuery:
    """Take up all new files, split good from rejected, and stop.

    Every micro-batch has a folder of its own that a replay overwrites, so each
    record is landed exactly once. Reading ``out`` gives ``batch`` and
    ``outcome`` (``good`` or ``rejected``) as columns.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        outcome = F.when(F.size("reject_reasons") > 0, "rejected").otherwise("good")
        judged = with_reject_reasons(batch).withColumn("outcome", outcome)
        target = f"{out}/dt={day}/batch={batch_id}"
        judged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("outcome").parquet(target)

    return (
        raw.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
