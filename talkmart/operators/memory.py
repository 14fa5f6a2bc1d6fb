"""A memory of scored texts: every distinct text is asked about once, whatever sentences and runs it comes in.

A text's key is a digest of the prompt's version and the text. Only distinct texts without a good answer are batched;
their answers, and the reason where there was none, are kept under the key and joined back to all sentences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmart.operators import scoring, upsert

#: ``attempts`` counts the batches a text was in.
MEMORY = T.StructType(
    [
        T.StructField("text_key", T.StringType()),
        T.StructField("sentiment_score", T.DoubleType()),
        T.StructField("category", T.StringType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("error", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
    ]
)
_ANSWER = ("sentiment_score", "category", "keyword", "ok", "error")


def prompt_version(scorer_id: str) -> str:
    """Changes with the instruction text and with the scorer, so that old answers are not used for a new prompt."""
    text = "\n".join((scorer_id, scoring.PROMPT_HEAD, scoring.PROMPT_RULES))
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def text_key(text: Column, version: str) -> Column:
    """NULL counts as the empty text."""
    return F.sha2(F.concat_ws("\n", F.lit(version), F.coalesce(text, F.lit(""))), 256)


def distinct_texts(sentences: DataFrame, version: str, text: str = "sentence") -> DataFrame:
    """(text_key, text): each different text once. A text that very many sentences share is thinned out before the shuffle."""
    keyed = sentences.select(text_key(F.col(text), version).alias("text_key"), F.coalesce(text, F.lit("")).alias("text"))
    # The key is made of the text: both together are hashed, one alone would have to be sorted to keep a text.
    return keyed.distinct()


def known_answers(texts: DataFrame, memory: DataFrame, few_texts: bool = False) -> DataFrame:
    """What the memory holds of these texts. ``few_texts`` is for a measured small number: then only its keys move."""
    keys = texts.select("text_key")
    return memory.join(F.broadcast(keys) if few_texts else keys, "text_key", "left_semi").select(*MEMORY.names)


def ask_unknown(
    texts: DataFrame,
    known: DataFrame,
    scorer: Callable[[str], str] | None = None,
    files: int = 10,
    strict: bool = False,
    calls_at_once: int = 1,
) -> DataFrame:
    """Memory rows of the texts that have no good answer yet. Write them before use: a scorer may answer otherwise next time."""
    good, tried = known.filter("ok").select("text_key"), known.select("text_key", F.col("attempts").alias("before"))
    open_texts = texts.join(good, "text_key", "left_anti").join(tried, "text_key", "left")
    parsed = scoring.score_sentences(
        open_texts, scorer, files, strict, key="text_key", text="text", carry=["before"], calls_at_once=calls_at_once, keep_text=False
    )
    attempts = (F.coalesce("before", F.lit(0)) + 1).cast("int").alias("attempts")
    # What a failed line happened to give is no answer.
    values = [F.when(F.col("ok"), F.col(c)).alias(c) for c in _ANSWER[:3]]
    return parsed.select(F.col("sentence_uuid").alias("text_key"), *values, "ok", "error", attempts)


def merge_answers(target: DataFrame, source: DataFrame, small_source: bool = False) -> DataFrame:
    """Newer answers take the place of older ones of the same text."""
    return upsert.merge(target, source, ["text_key"], [*_ANSWER, "attempts"], small_source)


def answered(
    sentences: DataFrame,
    answers: DataFrame,
    version: str,
    text: str = "sentence",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every sentence with the answer to its text, in the shape that ``scoring.classified`` takes.

    ``answers`` has each text once. A text that very many sentences share is split by AQE: it stands on the left.
    A text without any answer fails like one with a failed answer.
    """
    rows = sentences.select("sentence_uuid", text, *keep, text_key(F.col(text), version).alias("text_key"))
    found = rows.join(answers.select("text_key", *_ANSWER), "text_key", "left")
    ok = F.coalesce("ok", F.lit(False)).alias("ok")
    return found.select("sentence_uuid", F.col(text).alias("sentence"), *keep, *_ANSWER[:3], ok, F.when(~ok, F.coalesce("error", F.lit("not asked"))).alias("error"))
