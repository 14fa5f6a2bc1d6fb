"""The scoring job: sentences of the loaded days to classified keywords."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date
from functools import partial
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmart.operators import memory as scores
from talkmart.operators import scoring
from talkmart.plans.load import is_small
from talkmart.plans.text_job import PARTITIONS, days_between, scope
from talkmart.schemas import CLASSIFIED, CLASSIFIED_FAILED, SENTENCE_DATA, staged
from talkmart.session import sized_shuffles
from talkmart.sources import versions
from talkmart.sources.writers import drop_folder, path_exists, replaced_partitions, scope_bytes, write_partitions


def file_count(sentences: DataFrame, at_least: int = 10, rows_per_file: int = 500_000) -> int:
    """Number of batch files: grows with the data, so that none grows without bound."""
    return max(at_least, ceil(sentences.count() / rows_per_file))


def run_scoring(
    spark: SparkSession,
    out: str,
    first: str | date,
    last: str | date | None = None,
    cars: Sequence[str] | None = None,
    scorer: Callable[[str], str] | None = None,
    strict: bool = True,
    memory: str | None = None,
    scorer_id: str = "default",
    calls_at_once: int = 1,
) -> None:
    """``sentence_data`` -> ``classified`` and ``classified_failed``; ``scored`` also holds why a sentence failed.

    Replies are written before they are used, because a scorer may answer the
    same prompt differently a second time. With ``memory``, the folder of a score
    memory, each distinct text is asked about once and never again after a good
    answer; ``scorer_id`` must change with the scorer.
    """
    days = days_between(first, last)
    with sized_shuffles(spark, scope_bytes(spark, f"{out}/sentence_data", days, cars)):
        sentences = spark.read.schema(staged(SENTENCE_DATA)).parquet(f"{out}/sentence_data").filter(scope(days, cars))
        sentences = sentences.select("sentence_uuid", "sentence", *PARTITIONS)
        if memory is None:
            files = file_count(sentences)
            parsed = scoring.score_sentences(sentences, scorer, files, strict, carry=PARTITIONS, calls_at_once=calls_at_once)
        else:
            run = f"{memory}/runs/{uuid.uuid4().hex}"
            parsed = score_with_memory(sentences, memory, scorer, scorer_id, strict, calls_at_once, PARTITIONS, run)
        scored = _replace(spark, parsed, f"{out}/scored", days, cars)
        if memory is not None:
            drop_folder(spark, run)
        _replace(spark, scoring.classified(scored, PARTITIONS), f"{out}/classified", days, cars)
        _replace(spark, scoring.classified_failed(scored, PARTITIONS), f"{out}/classified_failed", days, cars)


#: Texts of a file where files are no more than groups of batches: small ones, so that the tasks that order them are many.
TEXTS_PER_FILE = 20_000


def score_with_memory(
    sentences: DataFrame,
    memory: str,
    scorer: Callable[[str], str] | None = None,
    scorer_id: str = "default",
    strict: bool = True,
    calls_at_once: int = 1,
    keep: Sequence[str] = (),
    run: str | None = None,
) -> DataFrame:
    """Every sentence with the answer to its text; texts without a good answer in the memory are asked about first.

    The run's distinct texts and new answers are written to the folder ``run`` (beside the memory) before they are used;
    it can go once the result is stored. The memory gets a new version with the answers. Strict fails all texts of a batch with a bad line; they are asked about next time.
    """
    spark, version = sentences.sparkSession, scores.prompt_version(scorer_id)
    run = run or f"{memory}/runs/{uuid.uuid4().hex}"
    scores.distinct_texts(sentences, version).write.parquet(f"{run}/texts")
    texts = spark.read.parquet(f"{run}/texts")
    few = is_small(texts.select("text_key"))
    stored = versions.read_keyed(spark, memory, scores.MEMORY, ("text_key",))
    scores.known_answers(texts, stored, few).write.parquet(f"{run}/known")
    known = spark.read.schema(scores.MEMORY).parquet(f"{run}/known")
    new = scores.ask_unknown(texts, known, scorer, file_count(texts, rows_per_file=TEXTS_PER_FILE), strict, calls_at_once)
    new.write.parquet(f"{run}/answers")
    new = spark.read.schema(scores.MEMORY).parquet(f"{run}/answers")
    small = is_small(new)
    merger = partial(scores.merge_answers, small_source=small)
    versions.upsert_keyed(new, memory, scores.MEMORY, ("text_key",), merger, small)
    answers = known.join(new.select("text_key"), "text_key", "left_anti").select(*scores.MEMORY.names).unionByName(new)
    return scores.answered(sentences, answers, version, keep=keep)


def _replace(spark: SparkSession, df: DataFrame, path: str, days: Sequence[str], cars: Sequence[str] | None) -> DataFrame:
    """Write the scope's partitions and give back what was written."""
    with replaced_partitions(spark, path, days, cars):
        write_partitions(df, path, PARTITIONS)
    return spark.read.schema(df.schema).parquet(path).filter(scope(days, cars))


def retry_failed(
    spark: SparkSession,
    out: str,
    first: str | date,
    last: str | date | None = None,
    scorer: Callable[[str], str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Score the failed sentences again and land the results; gives back the sentences scored now.

    Replies are written first (``scored_retry``). What succeeded is added to ``classified``, once even if a retry is
    repeated half-way, and ``classified_failed`` keeps what failed again.
    """
    days = days_between(first, last)
    failed = spark.read.schema(staged(CLASSIFIED_FAILED)).parquet(f"{out}/classified_failed").filter(scope(days))
    again = scoring.score_sentences(failed, scorer, file_count(failed), strict, carry=PARTITIONS)
    again = _replace(spark, again, f"{out}/scored_retry", days, None)
    good = scoring.classified(again, PARTITIONS)
    if path_exists(spark, f"{out}/classified"):
        known = spark.read.schema(staged(CLASSIFIED)).parquet(f"{out}/classified").filter(scope(days))
        good = good.join(known.select("sentence_uuid"), "sentence_uuid", "left_anti").select(*good.columns)
    good.write.mode("append").partitionBy(*PARTITIONS).parquet(f"{out}/classified")
    _replace(spark, scoring.classified_failed(again, PARTITIONS), f"{out}/classified_failed", days, None)
    return again.filter(F.col("ok"))
