"""Words, shingles and row keys as built-in expressions, shared by the operators of this subpackage."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Everything in ASCII that is neither a digit nor a lower-case letter, once A-Z are lowered.
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACES = r"[\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """Lower A-Z and leave all other letters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def alnum_words(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, lower-cased; [] for NULL."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_ALNUM, -1), "")


def space_words(text: Column, lower: bool = False) -> Column:
    """Runs of characters other than ASCII white space; [] for NULL."""
    text = F.coalesce(text, F.lit(""))
    return F.array_remove(F.split(lower_ascii(text) if lower else text, SPACES, -1), "")


def shingles(words: Column, width: Column | int) -> Column:
    """64-bit hashes of all runs of ``width`` words in order; [] where there are fewer words."""
    width = F.lit(width) if isinstance(width, int) else width
    last = F.size(words) - width + 1
    return F.when(
        last > 0,
        F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, width))),
    ).otherwise(F.array().cast("array<bigint>"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """One key for all rows with the same id and text, NULL text being empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("NULL")), text).cast("binary"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, row_key), one row per input row; all other columns go.

    NULL text becomes empty. Rows with the same id and text share a key, so an answer worked out per key
    fits all of them and no row is lost or doubled when it is joined back.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), row_key(id_col, text_col).alias("row_key"))


def free_name(docs: DataFrame, wish: str) -> str:
    """``wish``, with underscores added until no column of ``docs`` has the name, in whatever case."""
    taken = {c.lower() for c in docs.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def matches(text: Column, pattern: str, gate: str) -> Column:
    """All matches of ``pattern`` in ``text``, leftmost first and apart: an array of (start, end, raw).

    Start and end count code points, end is exclusive. The pattern cuts the text into gaps and matches whose
    lengths, added up, give the places. ``gate`` is a cheap pattern without which there is no match.
    """
    cut = F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    )

    def place(cut: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(cut["gaps"], i))
            end = start + F.length(F.get(cut["found"], i))
            return F.struct(end.alias("at"), F.concat(state["starts"], F.array(start)).alias("starts"))

        starts = F.aggregate(F.sequence(F.lit(0), F.size(cut["found"]) - 1), empty, step, lambda state: state["starts"])
        span = lambda start, raw: F.struct(start.alias("start"), (start + F.length(raw)).alias("end"), raw.alias("raw"))
        return F.zip_with(starts, cut["found"], span)

    placed = F.element_at(F.transform(F.array(cut), lambda c: F.when(F.size(c["found"]) > 0, place(c))), 1)
    return F.coalesce(F.when(text.rlike(gate), placed), F.array().cast("array<struct<start:int,end:int,raw:string>>"))
