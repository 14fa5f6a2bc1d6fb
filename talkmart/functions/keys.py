"""Identifiers: stable surrogate keys, content keys, ids taken from links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmart.functions.once import computed_once


def stable_key(*parts: Column) -> Column:
    """md5 over the parts, the same on every run and every action.

    Each part carries its length, and NULL has its own mark, so neither a
    separator inside a value nor a NULL can make two different keys equal.
    """
    marked = []
    for part in parts:
        text = part.cast("string")
        marked.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat_ws("|", *marked))


def packed(key: Column) -> Column:
    """A text key as bytes that are equal where the keys are: 16 for 32 lower-case hex digits, as md5 keys have.

    Half the bytes of the text in a shuffle. Other keys are followed by 17 zero bytes, so none of them can equal a
    short one. NULL stays NULL.
    """
    text = key.cast("string")
    # What ``unhex`` reads has hex digits only; its other work is less than a pattern's.
    short = (F.octet_length(text) == 32) & (F.lower(text) == text) & F.unhex(text).isNotNull()
    return F.when(short, F.unhex(text)).otherwise(F.concat(text.cast("binary"), F.unhex(F.lit("00" * 17))))


def with_packed(df: DataFrame, keys: Sequence[str], keep: Sequence[str | Column]) -> DataFrame:
    """``keys`` in packed form, and ``keep``. A key that is an expression is worked out once."""
    others = df.select(*keys, *keep)
    kept = [c for c in others.columns if c not in keys]
    return computed_once(others, kept, {k: F.col(k) for k in keys}).select(*(packed(F.col(k)).alias(k) for k in keys), *kept)


def content_key(owner_id: Column, nickname: Column, content: Column, compat: bool = False) -> Column:
    """Comment id: the owner's id, an underscore, and a hash of author and text.

    ``compat`` gives the 32-bit Murmur3 form, which skips NULLs and collides on
    large data; the default is the md5 form.
    """
    digest = F.hash(nickname, content).cast("string") if compat else stable_key(nickname, content)
    return F.concat(owner_id, F.lit("_"), digest)


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def query_id(link: Column) -> Column:
    """``…?code=x&No=123`` -> ``123``: what follows the last equals sign."""
    return F.substring_index(_stripped(link), "=", -1)


def path_id(link: Column) -> Column:
    """``…/board/123?po=0`` -> ``123``: last path segment before the query."""
    return F.substring_index(F.substring_index(_stripped(link), "?", 1), "/", -1)
