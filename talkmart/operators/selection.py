"""Work lists: keyword tagging, top-k, shards, batches, samples, distinct ids."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmart.schemas import CAR_ALIASES, SOURCES


def check_parameters(**values) -> None:
    """Job arguments that must not be empty."""
    empty = [name for name, value in values.items() if not value]
    if empty:
        raise ValueError(f"required: {', '.join(empty)}")


def only_sources(df: DataFrame, allowed: Iterable[str] = SOURCES, column: str = "source") -> DataFrame:
    return df.filter(F.col(column).isin(*allowed))


def matching_labels(text: Column, aliases: Mapping[str, str] = CAR_ALIASES) -> Column:
    """Array of every label that has one of its comma-listed words in the text.

    The alias list is configuration, so it becomes part of the expression; no
    join takes place.
    """
    hits = []
    for label, words in aliases.items():
        found = [text.contains(word.strip()) for word in words.split(",") if word.strip()]
        hit = found[0]
        for more in found[1:]:
            hit = hit | more
        hits.append(F.when(hit, F.lit(label)))
    return F.array_compact(F.array(*hits))


def tag_by_alias(
    df: DataFrame, column: str, aliases: Mapping[str, str] = CAR_ALIASES, label: str = "car_name"
) -> DataFrame:
    """One row per (row, matching label); rows that match nothing leave."""
    return df.withColumn(label, F.explode(matching_labels(F.col(column), aliases)))


def distinct_ids(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int = 50) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark keeps ``k`` rows per group and task before the shuffle, so a hot group
    moves no more than ``k`` rows from each task.
    """
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def hash_shard(key: Column, shards: int) -> Column:
    """Shard number from the first 7 hex digits of the key's md5; no shuffle."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 7), 16, 10).cast("int"), F.lit(shards))


def stride_shards(ids: DataFrame, key: str, shards: int = 10, fine_digits: int = 3) -> DataFrame:
    """Every ``shards``-th id to the same shard, over all distinct ids.

    Ids are laid out in md5 order. Positions come from two levels: the rank
    inside one of ``16 ** fine_digits`` md5 ranges, plus the number of ids in
    the ranges before it, so no window spans more than one range, and only the
    table of range sizes (at most ``16 ** fine_digits`` rows) is ordered as a whole.
    """
    coded = (
        ids.select(key)
        .distinct()
        .withColumn("_md5", F.md5(F.col(key).cast("string")))
        .withColumn("_range", F.substring("_md5", 1, fine_digits))
    )
    sizes = coded.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_offset"))
    in_range = F.row_number().over(Window.partitionBy("_range").orderBy("_md5", key)) - 1
    # Bounded: one row per md5 range.
    placed = coded.withColumn("_pos", in_range).join(F.broadcast(offsets), "_range")
    position = (F.col("_offset") + F.col("_pos")).cast("bigint")
    return placed.select(
        key, position.alias("position"), F.pmod(position, F.lit(shards)).cast("int").alias("shard")
    )


def validation_sample(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """``n`` rows for a spot check, the same ones on every run."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)
