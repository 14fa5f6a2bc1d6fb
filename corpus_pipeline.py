"""A training corpus from documents: known languages, no near duplicates, no benchmark text, no secrets, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkmart.llm import decontamination, jaccard, language, packing, secrets
from talkmart.llm.queries import tokenizer_path
from talkmart.llm.staging import stage

#: Tokens of a sequence.
SEQUENCE = 2048

# Classifiers and packing have no SQL form; the stages are tested against brute-force versions.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a known language and set ``lang`` to it."""
    return language.known_language(docs, language.fit_text_model(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group."""
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark passages."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in the place of each secret; every document stays."""
    return secrets.redact(docs, stage(secrets.scan(docs), "secrets"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences."""
    return packing.pack_documents(docs, tokenizer_path(), packing.Capacity(SEQUENCE), keep_ids=False)


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", remove_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
