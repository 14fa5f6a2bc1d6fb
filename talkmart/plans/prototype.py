"""The earlier single-pass flow: per-source files to scored text in one CSV."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from talkmart.functions.keys import stable_key
from talkmart.functions.text import HANGUL, clean_flat_text
from talkmart.operators import scoring
from talkmart.operators.normalize import flatten_text
from talkmart.plans.score import file_count
from talkmart.schemas import FLAT_TEXT
from talkmart.sources.readers import read_json_lines, read_per_source
from talkmart.sources.writers import fill_missing_with_zero, write_csv, write_json_lines


def run_prototype(
    spark: SparkSession,
    folder: str,
    name: str,
    out: str,
    sources: Sequence[str] = ("youtube", "clien"),
    scorer: Callable[[str], str] | None = None,
    script: str = HANGUL,
) -> None:
    """Read per-source files, flatten, clean, write JSON Lines; score; write CSV.

    Equal texts are scored once and share the result. Lines the scorer did not
    answer carry ``error`` in the label columns.
    """
    raw = read_per_source(spark, folder, name, sources)
    write_json_lines(clean_flat_text(flatten_text(raw), script=script), f"{out}/transformed")
    rows = fill_missing_with_zero(read_json_lines(spark, f"{out}/transformed", FLAT_TEXT))
    keyed = rows.withColumn("text_key", stable_key(F.col("text")))
    texts = keyed.select("text_key", "text").distinct()
    parsed = scoring.score_sentences(texts, scorer, file_count(texts), strict=False, key="text_key", text="text")
    parsed.write.mode("overwrite").parquet(f"{out}/scored")
    scores = spark.read.parquet(f"{out}/scored").select(
        F.col("sentence_uuid").alias("text_key"),
        F.when(F.col("ok"), F.col("sentiment_score").cast("string")).otherwise("error").alias("sentiment"),
        F.when(F.col("ok"), F.col("category")).otherwise("error").alias("topic"),
        F.when(F.col("ok"), F.col("keyword")).otherwise("error").alias("subtopic"),
    )
    write_csv(keyed.join(scores, "text_key", "left").drop("text_key"), f"{out}/scored_csv")
