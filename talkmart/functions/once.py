"""Keep long expressions from being worked out more than once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, with ``value`` worked out once however often it is named."""
    return F.element_at(F.transform(F.array(value), body), 1)


def computed_once(df: DataFrame, keep: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Select ``keep`` and ``columns`` so that the new columns are worked out once per row.

    A plain select would be merged into whatever uses it, which repeats long
    extraction expressions for every later mention and in pushed-down filters.
    """
    packed = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select(*keep, F.inline(F.array(packed)))
