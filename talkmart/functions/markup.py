r"""Text and blocks out of stored HTML, as Column expressions.

Blocks are cut with regular expressions; nested elements of the same name are
balanced by counting opening and closing tags. Only entity decoding leaves the JVM.
"""

from __future__ import annotations

import html as _html

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmart.functions.once import let

_BREAK = "\u0001"
_NOT_TEXT = r"(?is)<(script|style|template)\b.*?</\1\s*>|<!--.*?-->|<!doctype[^>]*>|<[a-z/][^>]*>"
_EDGES = r"(?U)^\s+|\s+$"


@F.udf(T.StringType(), useArrow=False)
def decode_entities(value: str | None) -> str | None:
    """``&amp;`` and all other HTML entities to characters; NULL stays NULL.

    Not by Arrow: its batches hold 10,000 pages' texts at once, in several copies; these hold 100.
    """
    return value if value is None else _html.unescape(value)


def strip(text: Column) -> Column:
    """Strip every kind of white space, no-break spaces included."""
    return F.regexp_replace(text, _EDGES, "")


def text_of(markup: Column) -> Column:
    """Text nodes run together; entities still coded."""
    return F.regexp_replace(markup, _NOT_TEXT, "")


def broken_text(markup: Column) -> Column:
    """Text nodes with a break mark where markup was; entities still coded."""
    return F.regexp_replace(markup, _NOT_TEXT, _BREAK)


def joined_lines(text: Column) -> Column:
    """From ``broken_text``: each node stripped, empty ones left out, one per line."""
    nodes = F.transform(F.split(text, _BREAK), strip)
    return F.array_join(F.filter(nodes, lambda node: node != ""), "\n")


def lines_of(markup: Column) -> Column:
    """Text nodes, entities decoded, each stripped, empty ones left out, one per line."""
    return joined_lines(decode_entities(broken_text(markup)))


def open_tag(tag: str, css_class: str | None = None) -> str:
    """Pattern for an opening tag, with a class among its classes if one is given."""
    if css_class is None:
        return rf"(?is)<{tag}\b[^>]*>"
    return rf"""(?is)<{tag}\b[^>]*\bclass\s*=\s*["'](?:[^"'>]*\s)?{css_class}(?:\s[^"'>]*)?["'][^>]*>"""


def after_tag(markup: Column, tag: str, css_class: str | None = None) -> Column:
    """Everything that follows the first such opening tag, else NULL."""
    return F.try_element_at(F.split(markup, open_tag(tag, css_class), 2), F.lit(2))


def element(markup: Column, tag: str, css_class: str | None = None) -> Column:
    """Inner markup of the first such element, up to its own closing tag."""
    return balanced(after_tag(markup, tag, css_class), tag)


def balanced(tail: Column, tag: str) -> Column:
    """Cut what follows an opening tag at the closing tag that belongs to it."""
    def step(state: Column, piece: Column) -> Column:
        change = (
            F.when(piece.rlike(rf"(?i)^<{tag}\b"), 1).when(piece.rlike(rf"(?i)^</{tag}\s*>"), -1).otherwise(0)
        )
        depth = state["depth"] + change
        done = (state["depth"] == 0) | (depth == 0)
        return F.struct(
            F.when(done, 0).otherwise(depth).alias("depth"),
            (state["kept"] + F.when(done, 0).otherwise(1)).alias("kept"),
        )

    def cut(pieces: Column) -> Column:
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("kept"))
        return F.array_join(F.slice(pieces, 1, F.aggregate(pieces, start, step, lambda s: s["kept"])), "")

    return let(F.split(tail, rf"(?i)(?=<{tag}\b)|(?=</{tag}\s*>)"), cut)


def leaf(markup: Column, tag: str, css_class: str | None = None) -> Column:
    """Inner markup of the first such element that does not nest in itself."""
    return F.try_element_at(F.split(after_tag(markup, tag, css_class), rf"(?i)</{tag}\s*>", 2), F.lit(1))


def sections(markup: Column, tag: str, css_class: str | None = None) -> Column:
    """What follows each such opening tag, up to the next one, as an array."""
    return let(
        F.split(markup, open_tag(tag, css_class)),
        lambda pieces: F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
    )


def attribute(markup: Column, tag: str, name: str) -> Column:
    """An attribute of the first such tag, else NULL; entities still coded."""
    pattern = rf"""(?is)\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""

    def value(opening: Column) -> Column:
        either = F.concat(F.regexp_extract(opening, pattern, 1), F.regexp_extract(opening, pattern, 2))
        return F.when(opening.rlike(pattern), either)

    return let(F.regexp_extract(markup, open_tag(tag), 0), value)


def links_of(markup: Column) -> Column:
    """All link targets, in page order."""
    return F.regexp_extract_all(markup, F.lit(r"""(?is)<a\b[^>]*\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1))
