"""Sentence cleaning as one Column expression plus filters."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmart.functions.once import computed_once

# What is dropped from a sentence, in this order. The order
# matters: commas go before runs of marks are shortened, so ",," leaves nothing.
URL = r"http\S+"
MENTION = r"@\S+"
HASHTAG = r"#\S+"
QUOTES_AND_BRACKETS = r'[",\[\]]+'
REPEATED_MARK = r"([.!?,~])\1+"
INVISIBLE = r"[\u200B-\u200F\u202A-\u202E\u2060-\u206F\uFEFF\u00A0]"
WHITESPACE = r"\s+"
# What any of these finds stands in a text that has one of the characters or strings here; others have nothing to strip.
STRIPPED_CHARACTER = rf'[@#",\[\]\t\n\x0B\f\r{INVISIBLE[1:-1]}]'
STRIPPED_STRINGS = ("http", "  ", "..", "!!", "??", "~~")

HANGUL = "[가-힣]"
MIN_LENGTH = 10
SPELLING = {"투산+": "투싼"}


def clean(text: Column, spelling: Mapping[str, str] | None = None) -> Column:
    """Lower-case, strip links, handles, tags and marks, squeeze whitespace."""
    text = stripped = F.lower(text)
    for pattern in (URL, MENTION, HASHTAG):
        stripped = F.regexp_replace(stripped, pattern, "")
    stripped = F.when(text.rlike(rf"[@#]\S|{URL}"), stripped).otherwise(text)
    stripped = F.regexp_replace(stripped, QUOTES_AND_BRACKETS, "")
    stripped = F.regexp_replace(stripped, REPEATED_MARK, "$1")
    stripped = F.regexp_replace(stripped, INVISIBLE, "")
    stripped = F.regexp_replace(stripped, WHITESPACE, " ")
    # Most sentences have nothing to strip: one look instead of a pass for each step.
    looked_for = reduce(or_, (text.contains(part) for part in STRIPPED_STRINGS), text.rlike(STRIPPED_CHARACTER))
    text = F.trim(F.when(looked_for, stripped).otherwise(text))
    for pattern, canonical in (spelling or {}).items():
        text = F.regexp_replace(text, pattern, canonical)
    return text


def longer_than(text: Column, n: int = MIN_LENGTH) -> Column:
    return F.length(text) > n


def has_script(text: Column, script: str = HANGUL) -> Column:
    return text.rlike(script)


def clean_sentences(
    df: DataFrame, column: str = "sentence", script: str = HANGUL, min_length: int = MIN_LENGTH
) -> DataFrame:
    """Length and script filter on the raw text, clean, then length filter again."""
    raw = F.col(column)
    kept = df.filter(longer_than(raw, min_length) & has_script(raw, script))
    return _replaced(kept, column, clean(raw)).filter(longer_than(F.col(column), min_length))


def _replaced(df: DataFrame, column: str, value: Column) -> DataFrame:
    others = [c for c in df.columns if c != column]
    # The filters on the result must not repeat the cleaning.
    return computed_once(df, others, {column: value}).select(*df.columns)


def clean_flat_text(
    df: DataFrame,
    column: str = "text",
    script: str = HANGUL,
    min_length: int = MIN_LENGTH,
    spelling: Mapping[str, str] = SPELLING,
) -> DataFrame:
    """Clean first and filter only the result; also unifies spelling variants."""
    cleaned = _replaced(df, column, clean(F.col(column), spelling))
    return cleaned.filter(has_script(F.col(column), script) & longer_than(F.col(column), min_length))
