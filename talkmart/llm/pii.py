"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Everything happens inside a row with built-in expressions. A pattern cuts the text into gaps and matches;
their lengths, added up, give the places of the matches. Patterns start only where a run of their characters
starts (or where the last match ended), which finds the same matches as trying every character and takes
linear time on long runs. A match that its validator rejects is dropped and not tried again from inside.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmart.functions.once import computed_once
from talkmart.llm.text import matches

#: Characters on either side of a span in which context words count.
NEARBY = 48
#: Spans of the method's own kinds with a lower score are dropped.
MIN_SCORE = 0.6


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def _digit(digits: Column, place: Column) -> Column:
    return F.substring(digits, place, F.lit(1)).cast("int")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, back: Column) -> Column:
        digit = _digit(digits, F.length(digits) - back)
        twice = 2 * digit
        return total + F.when(back % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number (letters A-Z and digits) leaves 1 modulo 97 once its first four characters are last."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code) - 4), F.substring(code, 1, 4))

    def add(rest: Column, place: Column) -> Column:
        char = F.substring(turned, place, F.lit(1))
        value = F.when(char <= "9", char.cast("int")).otherwise(F.ascii(char) - 55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _count(low: int, high: int) -> Callable[[Column], Column]:
    return lambda raw: F.length(_digits(raw)).between(low, high)


def _card(raw: Column) -> Column:
    return F.when(_count(13, 19)(raw), luhn(_digits(raw))).otherwise(False)


def _ip(raw: Column) -> Column:
    # A part of any length: leading zeros do not count, and three digits are then enough to compare.
    small = lambda part: F.ltrim(part, F.lit("0"))
    return F.forall(F.split(raw, r"\."), lambda p: (F.length(small(p)) < 3) | ((F.length(small(p)) == 3) & (small(p) <= "255")))


def _iban(raw: Column) -> Column:
    code = F.translate(raw, " ", "")
    return F.when(F.length(code).between(15, 34), mod97(code)).otherwise(False)


def _number(raw: Column) -> Column:
    """A social security number outside the blocks that are never given out."""
    area, group, serial = F.substring(raw, 1, 3), F.substring(raw, 5, 2), F.substring(raw, 8, 4)
    return ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``gate``: a cheap pattern without which the text has none. ``score``: before context. ``context``: words that
    add to it when near. Kinds that are ``base`` stay whatever their score.
    """

    name: str
    pattern: str
    gate: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    base: bool = True


#: Possessive quantifiers keep long runs linear; nothing follows them that could ask for a shorter run.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        lambda raw: F.lit(True),
        0.9,
        r"\b(mail|e-mail|email|contact|write)\b",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", _ip, 0.7, r"\b(ip|host|server|address|login)\b"),
    Kind("card", r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++", "[0-9]{2}|[0-9][ -][0-9]", _card, 0.8, r"\b(card|visa|credit|payment|cvv)\b"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _count(9, 15), 0.8, r"\b(phone|tel|call|mobile|fax)\b"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", _iban, 0.9, r"\b(iban|account|bank|konto)\b", False),
    Kind("local_phone", r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", "[0-9]{4}", _count(10, 10), 0.4, r"\b(phone|tel|call|mobile|fax)\b", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", _number, 0.4, r"\b(ssn|social security)\b", False),
)
#: What a context word nearby adds to a score.
CONTEXT_BONUS = 0.3


def _spans(text: Column, kind: Kind) -> Column:
    """The matches of a kind that its validator confirms."""
    return F.filter(matches(text, kind.pattern, kind.gate), lambda x: kind.valid(x["raw"]))


def _scored(text: Column, spans: Column, kind: Kind) -> Column:
    """``spans`` with a score: the kind's own, more with a context word near."""

    def score(x: Column) -> Column:
        first = F.greatest(F.lit(1), x["start"] + 1 - NEARBY)
        near = F.concat(
            F.substring(text, first, x["start"] + 1 - first), F.lit(" "), F.substring(text, x["end"] + 1, F.lit(NEARBY))
        )
        points = F.when(F.lower(near).rlike(kind.context), min(1.0, kind.score + CONTEXT_BONUS)).otherwise(kind.score)
        return F.struct(F.lit(kind.name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["raw"].alias("raw"), points.alias("score"))

    return F.transform(spans, score)


def personal_data(docs: DataFrame, min_score: float = MIN_SCORE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans, an array of (kind, start, end, raw, score).

    Spans stand by kind in the order of ``KINDS``, then by start. Spans of the base kinds are all there; those of
    other kinds must reach ``min_score`` and not touch a base span. NULL and empty texts have no spans. Repeated
    rows and NULL ids are kept as they are; other columns go.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    text = F.col("text")
    docs = computed_once(docs, ["doc_id", "text"], {kind.name: _spans(text, kind) for kind in KINDS})
    docs = computed_once(docs, ["doc_id"], {kind.name: _scored(text, F.col(kind.name), kind) for kind in KINDS})
    base = F.concat(*(F.col(kind.name) for kind in KINDS if kind.base))

    def own(spans: Column) -> Column:
        apart = lambda x: ~F.exists(base, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
        return F.filter(spans, lambda x: (x["score"] >= min_score) & apart(x))

    every = F.concat(base, *(own(F.col(kind.name)) for kind in KINDS if not kind.base))
    return computed_once(docs, ["doc_id"], {"spans": every})


def marks(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(*(kind.name for kind in KINDS if kind.base)))
