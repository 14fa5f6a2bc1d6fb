"""Counts and positional tokens out of display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_count(text: Column, default: int | None = 0) -> Column:
    """``"1,234"`` -> 1234; anything that is no number -> ``default``.

    With ``default=None`` a failure stays NULL, so that the row can be rejected.
    """
    number = F.replace(text, F.lit(","), F.lit("")).try_cast("int")
    return number if default is None else F.coalesce(number, F.lit(default))


def token(text: Column, *steps: tuple[str, int]) -> Column:
    """Split, take one piece, strip it, and go on with the next step.

    A step is ``(separator, index)``; indexes count from 0, or from the end
    when negative. A piece that is not there is NULL.
    """
    for separator, index in steps:
        pieces = F.split(F.trim(text), "\\Q" + separator + "\\E")
        text = F.try_element_at(pieces, F.lit(index + 1 if index >= 0 else index))
    return F.trim(text)


def or_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))
