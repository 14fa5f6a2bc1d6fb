"""Tagging text with many aliases: an index of each alias by its rarest pair of characters.

``selection.tag_by_alias`` puts a short alias list into one expression. A list of many thousands is a table here.
An alias stands in a text only if all its pairs of neighbouring characters do, so each alias is filed under the one
pair that the fewest texts have, the distinct pairs of a text are looked up, and what is found is compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmart.functions.once import let

#: Aliases up to this number (some hundred bytes each) are sent to every executor.
BROADCAST_ALIASES = 200_000


def character_pairs(text: Column) -> Column:
    """The distinct pairs of neighbouring characters and the distinct characters of a text; [] for NULL and empty."""

    def pieces(chars: Column) -> Column:
        rest = F.slice(chars, 2, F.greatest(F.size(chars), F.lit(1)))
        return F.concat(F.transform(rest, lambda c, i: F.concat(F.get(chars, i), c)), chars)

    chars = F.filter(F.split(F.coalesce(text, F.lit("")), "", -1), lambda c: c != "")
    return F.array_distinct(let(chars, pieces))  # else the lambda would cut the text again for each character


def _alias_pairs(alias: Column) -> Column:
    """What an alias can be filed under: its pairs, or itself if it is one character."""
    return F.filter(character_pairs(alias), lambda p: (F.length(p) == 2) | (F.length(alias) == 1))


def clean_aliases(aliases: DataFrame, label: str = "label", alias: str = "alias") -> DataFrame:
    """(label, alias): trimmed, without NULL and blank ones, each once. ``alias`` may be a comma-listed string."""
    each = F.explode(F.split(F.col(alias), ",", -1))
    rows = aliases.select(F.col(label).alias("label"), each.alias("alias"))
    return rows.select("label", F.trim("alias").alias("alias")).filter("alias <> '' AND label IS NOT NULL").distinct()


def pair_counts(texts: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """(pair, texts): in how many rows each pair of the aliases stands. Pairs that stand in none are left out."""
    wanted = aliases.select(F.explode(_alias_pairs(F.col("alias"))).alias("pair")).distinct()
    found = texts.select(F.explode(character_pairs(F.col(column))).alias("pair"))
    return found.join(wanted, "pair", "left_semi").groupBy("pair").agg(F.count(F.lit(1)).alias("texts"))


def alias_index(aliases: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(pair, alias): each distinct alias under one of its pairs, the rarest by ``counts``, ties by the pair.

    A pair that ``counts`` does not have is the rarest of all, so counts of other days serve as well; they shape the
    cost and never the result. Without counts, pairs are rare that few aliases have.
    """
    filed = aliases.select("alias").distinct().select("alias", F.explode(_alias_pairs(F.col("alias"))).alias("pair"))
    if counts is None:
        counts = filed.groupBy("pair").agg(F.count(F.lit(1)).alias("texts"))
    ranked = filed.join(counts, "pair", "left").withColumn("texts", F.coalesce("texts", F.lit(0)))
    first = Window.partitionBy("alias").orderBy("texts", "pair")
    return ranked.withColumn("rank", F.row_number().over(first)).filter("rank = 1").select("pair", "alias")


def alias_matches(
    texts: DataFrame, column: str, aliases: DataFrame, counts: DataFrame | None = None, most: int = BROADCAST_ALIASES
) -> DataFrame:
    """(digest, label, alias) of each alias in each distinct text; ``digest`` is the sha-256 of the text.

    ``aliases`` has a label and an alias a row, ``counts`` comes from ``pair_counts``. An alias is compared once in a
    text, however many labels it has. The distinct aliases are counted: up to
    ``most`` are broadcast and the texts do not move. More of them meet the pairs of the texts in a shuffle that
    carries digests only, and the candidates then meet each text once. Both ways give the same rows. Case counts, as
    in ``selection.tag_by_alias``.
    """
    aliases = clean_aliases(aliases)
    filed = alias_index(aliases, counts)
    text = F.col(column)
    whole = texts.filter(text.isNotNull()).select(F.sha2(text, 256).alias("digest"), text.alias("text"))
    if aliases.select("alias").distinct().limit(most + 1).count() <= most:
        paired = whole.select("digest", "text", F.explode(character_pairs(F.col("text"))).alias("pair"))
        found = paired.join(F.broadcast(filed), "pair")
    else:
        paired = whole.select("digest", F.explode(character_pairs(F.col("text"))).alias("pair"))
        candidates = paired.join(filed, "pair").select("digest", "alias").distinct()
        found = whole.join(candidates, "digest")
    found = found.filter(F.contains("text", "alias")).select("digest", "alias").distinct()
    return found.join(aliases, "alias").select("digest", "label", "alias")


def tag_by_alias_table(
    df: DataFrame, column: str, aliases: DataFrame, label: str = "car_name", counts: DataFrame | None = None, **limits: int
) -> DataFrame:
    """One row per (row, label with an alias in ``column``), as ``selection.tag_by_alias``, for any number of aliases.

    Rows that match nothing leave; equal rows stay equal in number. A row whose text is NULL matches nothing.
    """
    if label in df.columns:
        raise ValueError(f"column exists: {label}")
    tags = alias_matches(df, column, aliases, counts, **limits).select("digest", "label").distinct()
    # Struct and alias keep the join's names apart from whatever columns the rows have.
    rows = df.select(F.struct(*map(F.col, df.columns)).alias("row"), F.sha2(F.col(column), 256).alias("digest"))
    return rows.join(tags, "digest").select("row.*", F.col("label").alias(label))
