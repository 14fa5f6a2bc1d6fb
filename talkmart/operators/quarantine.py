"""Split raw records into usable ones and rejected ones."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmart.schemas import COUNTERS


def _missing(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def _faults(df: DataFrame, counters: Iterable[str]) -> list[tuple[str, Column]]:
    faults = [(f"{f.name} missing", _missing(f)) for f in df.schema.fields]
    return faults + [(f"{c} negative", F.coalesce(F.col(c) < 0, F.lit(False))) for c in counters]


def is_rejected(df: DataFrame, counters: Iterable[str] = COUNTERS) -> Column:
    """True where any column, the comment array included, is NULL or a counter is below zero."""
    return reduce(lambda a, b: a | b, (fault for _, fault in _faults(df, counters)))


def reject_reasons(df: DataFrame, counters: Iterable[str] = COUNTERS) -> Column:
    """Array with the reasons a row of ``df`` is rejected for, empty for a usable row."""
    marks = [F.when(fault, F.lit(reason)) for reason, fault in _faults(df, counters)]
    return F.array_compact(F.array(*marks))


def with_reject_reasons(df: DataFrame, counters: Iterable[str] = COUNTERS) -> DataFrame:
    """Adds ``reject_reasons``. One pass, no shuffle."""
    return df.withColumn("reject_reasons", reject_reasons(df, counters))


def good_rows(df: DataFrame, counters: Iterable[str] = COUNTERS) -> DataFrame:
    return df.filter(~is_rejected(df, counters))


def rejected_rows(df: DataFrame, counters: Iterable[str] = COUNTERS) -> DataFrame:
    """Every rejected row with its reasons; duplicates are kept."""
    return with_reject_reasons(df.filter(is_rejected(df, counters)), counters)


def rejected_distinct(df: DataFrame, counters: Iterable[str] = COUNTERS) -> DataFrame:
    """Rejected rows as a set difference: equal bad rows count once.

    The result of ``df EXCEPT good``, written as a filter, so that only rejected
    rows take part in the shuffle that removes duplicates.
    """
    return df.filter(is_rejected(df, counters)).distinct()


def drop_blank_comments(df: DataFrame, column: str = "comments") -> DataFrame:
    """Optional: take comments without author or text out of the array."""
    return df.withColumn(
        column,
        F.filter(
            column,
            lambda c: c["comment_content"].isNotNull() & c["comment_nickname"].isNotNull(),
        ),
    )
