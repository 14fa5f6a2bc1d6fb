"""Keyed loads: one row per key from staging, then merge into a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmart.functions.timefn import SEOUL, to_local_date

_SOURCE = "_src_"

#: Bytes of values up to which a source may be broadcast.
SMALL_SOURCE_BYTES = 64 * 1024 * 1024

#: Columns of a stored dimension that say which load a row came from.
LOADED = ("load_day", "load_car")


def measured_bytes(df: DataFrame) -> int:
    """Size of the values in ``df``, by reading them: text bytes, 16 per other value."""
    sizes = [
        F.coalesce(F.octet_length(f.name), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(16)
        for f in df.schema.fields
    ]
    row = sizes[0]
    for size in sizes[1:]:
        row = row + size
    return df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("bytes")).first()["bytes"]


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (SMALL_SOURCE_BYTES if limit is None else limit)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str | Sequence[str] = "create_timestamp") -> DataFrame:
    """One row per key: the newest by one or more columns, ties broken by all other columns.

    The order is total, so the survivor does not depend on partitioning. Spark
    keeps one row per key and task before the shuffle, which takes the weight
    off keys with many copies.
    """
    first = [newest] if isinstance(newest, str) else list(newest)
    others = [f.name for f in df.schema.fields if f.name not in (*keys, *first) and _sortable(f)]
    order = [*(F.col(c).desc_nulls_last() for c in first), *(F.col(c).asc_nulls_first() for c in others)]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def _sortable(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.MapType, T.VariantType))


def _load_columns(loaded: bool) -> list[Column]:
    """The day and car of the load, from the columns of a staged post."""
    return [F.col("dt").cast("date").alias("load_day"), F.col("car_name").alias("load_car")] if loaded else []


def _newest(loaded: bool) -> list[str]:
    return [*(LOADED if loaded else ()), "create_timestamp"]


def posts_to_load(staged_posts: DataFrame, zone: str = SEOUL, loaded: bool = False) -> DataFrame:
    """Staged posts in the shape of the post dimension, one per ``post_id``.

    ``loaded`` adds the load's day and car from ``dt`` and ``car_name``; a later load then comes first.
    """
    staged = staged_posts.select("post_id", "title", "author", "article", "create_timestamp", *_load_columns(loaded))
    return _with_create_date(latest_per_key(staged, ["post_id"], _newest(loaded)), zone)


def comments_to_load(
    staged_comments: DataFrame, staged_posts: DataFrame, zone: str = SEOUL, loaded: bool = False
) -> DataFrame:
    """Staged comments with their post's id, one per ``comment_id``; ``loaded`` as for posts."""
    owners = staged_posts.select("post_uuid", "post_id", *_load_columns(loaded))
    staged = staged_comments.select(
        "post_uuid", "comment_id", "author", "content", "create_timestamp"
    ).join(owners, "post_uuid")
    return _with_create_date(latest_per_key(staged.drop("post_uuid"), ["comment_id"], _newest(loaded)), zone).select(
        "post_id", "comment_id", "author", "content", "create_date", *(LOADED if loaded else ())
    )


def _with_create_date(df: DataFrame, zone: str) -> DataFrame:
    return df.withColumn("create_date", to_local_date(F.col("create_timestamp"), zone)).drop("create_timestamp")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    small_source: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """Target after the merge: matched rows take ``update`` columns from the
    source, unmatched source rows are inserted, nothing is deleted.

    With ``order`` a matched row changes only if the source's ``order`` columns
    are not below the target's, and these columns are updated with it. Merges
    of any loads in any order then end in the same table.

    ``source`` must hold each key once. ``small_source=True`` is for a source
    whose size was checked (see ``is_small``): it is broadcast and the
    target does not move. Otherwise one full outer join shuffles both sides.
    """
    columns = target.columns
    update = [*update, *order]
    newer = F.col("_hit")
    for old, new in [(F.struct(*order), F.struct(*(F.col(_SOURCE + c) for c in order)))] if order else []:
        newer = newer & (new >= old)
    arriving = source.select(*(F.col(c).alias(_SOURCE + c) for c in columns)).withColumn("_hit", F.lit(True))
    same_key = _all_equal(keys)
    if not small_source:
        joined = target.withColumn("_old", F.lit(True)).join(arriving, same_key, "full_outer")
        return joined.select(*(_merged(c, keys, update, newer) for c in columns))
    kept = target.join(F.broadcast(arriving), same_key, "left").select(
        *(_merged(c, (), update, newer) for c in columns)
    )
    matched = target.select(*keys).join(F.broadcast(source.select(*keys)), list(keys), "left_semi").distinct()
    return kept.unionByName(source.select(*columns).join(matched, list(keys), "left_anti"))


def _all_equal(keys: Sequence[str]) -> Column:
    condition = F.col(keys[0]) == F.col(_SOURCE + keys[0])
    for key in keys[1:]:
        condition = condition & (F.col(key) == F.col(_SOURCE + key))
    return condition


def _merged(column: str, keys: Sequence[str], update: Sequence[str], newer: Column) -> Column:
    old, new = F.col(column), F.col(_SOURCE + column)
    if column in keys:
        return F.coalesce(old, new).alias(column)
    if column in update:
        new_to_target = F.col("_old").isNull() if keys else F.lit(False)
        return F.when(new_to_target | newer, new).otherwise(old).alias(column)
    if not keys:
        return old
    # Never updated: only rows new to the target take the source's value.
    return F.when(F.col("_old"), old).otherwise(new).alias(column)


def merge_posts(
    target: DataFrame, incoming: DataFrame, small_source: bool = False, order: Sequence[str] = ()
) -> DataFrame:
    update = ["title", "author", "article", "create_date"]
    return merge(target, incoming, ["post_id"], update, small_source, order)


def merge_comments(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] = ("comment_id",),
    small_source: bool = False,
    order: Sequence[str] = (),
) -> DataFrame:
    """``post_id`` is set on insert and never updated; ``keys`` may add it to the match."""
    return merge(target, incoming, list(keys), ["author", "content", "create_date"], small_source, order)
