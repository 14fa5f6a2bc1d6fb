"""The warehouse load: staging tables to dimensions, facts and views."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmart.operators import facts, upsert, views
from talkmart.operators.selection import check_parameters
from talkmart.operators.upsert import is_small, measured_bytes  # noqa: F401
from talkmart.plans.text_job import days_between, scope
from talkmart.schemas import MART, STAGING, STAGING_DIRS, VIEWS, staged
from talkmart.session import sized_shuffles, stored_bytes
from talkmart.sources import versions
from talkmart.sources.readers import next_snapshot_id, read_snapshot, snapshot_ids
from talkmart.sources.writers import (
    append_facts,
    drop_folder,
    drop_snapshots,
    path_exists,
    replaced_partitions,
    scope_bytes,
    write_snapshot,
)

#: What a dimension's rows are merged by.
DIMENSION_KEYS = {"tb_posts": ("post_id",), "tb_comments": ("comment_id",)}


def read_staging_days(
    spark: SparkSession, base: str, days: Sequence[str], cars: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """The staging tables of the days, cast to their declared types, with ``dt``."""
    tables = {}
    for name, table in STAGING.items():
        folder, schema = STAGING_DIRS[name]
        df = spark.read.schema(staged(schema)).parquet(f"{base}/{folder}").filter(scope(days, cars))
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]
        tables[name] = df.select(*columns, "dt")
    return tables


def stored_dimension(name: str) -> T.StructType:
    """A dimension as its snapshots hold it: with the day and car of the load each row came from."""
    loaded = [T.StructField("load_day", T.DateType()), T.StructField("load_car", T.StringType())]
    return T.StructType([*MART[name].schema.fields, *loaded])


def read_dimension(spark: SparkSession, mart: str, name: str, version: str | None = None) -> DataFrame:
    """The post or comment dimension, in its newest or a given version."""
    rows = versions.read_keyed(spark, f"{mart}/{name}", stored_dimension(name), DIMENSION_KEYS[name], version)
    return rows.select(*MART[name].columns)


def upsert_dimensions(spark: SparkSession, staging: dict[str, DataFrame], mart: str) -> dict[str, str]:
    """New versions of posts and comments: the newest one there is, merged with staging.

    A version's number is above all others', whatever days or cars it loads, so no
    load is lost to a later number. A row changes only if it comes from the same or
    a later day (within a day: the same or a later car by name), so days and cars
    may be loaded in any order, and a late day fills in what is missing without
    setting newer rows back. A version writes the rows that change; see ``sources.versions``.

    The deduplicated source is written first, under a number of its own: its size is
    then known exactly, and a small one is broadcast instead of moving the dimension.
    A mart that still holds whole snapshots is taken over by its first load.
    """
    sources = {
        "tb_posts": upsert.posts_to_load(staging["posts"], loaded=True),
        "tb_comments": upsert.comments_to_load(staging["comments"], staging["posts"], loaded=True),
    }
    mergers = {"tb_posts": upsert.merge_posts, "tb_comments": upsert.merge_comments}
    run, numbers = uuid.uuid4().hex, {}
    for name, incoming in sources.items():
        schema, base = stored_dimension(name), f"{mart}/{name}"
        landed = f"{mart}/incoming/{run}/{name}"
        incoming.write.parquet(landed)
        source = spark.read.schema(schema).parquet(landed)
        small = is_small(source)
        merger = partial(mergers[name], small_source=small, order=upsert.LOADED)
        old = read_snapshot(spark, base, schema) if snapshot_ids(spark, base) else None
        numbers[name] = versions.upsert_keyed(source, base, schema, DIMENSION_KEYS[name], merger, small, initial=old)
        drop_snapshots(spark, base, snapshot_ids(spark, base))
    drop_folder(spark, f"{mart}/incoming/{run}")
    return numbers


def append_day_facts(
    spark: SparkSession,
    staging: dict[str, DataFrame],
    mart: str,
    days: Sequence[str],
    cars: Sequence[str] | None = None,
    compat_uuid: bool = False,
) -> None:
    """The three facts of the days; a rerun replaces its own (day, car) partitions."""
    posts, comments = staging["posts"], staging["comments"]
    new_facts = {
        "tb_posts_metric": facts.post_metrics(posts, day_column="dt"),
        "tb_comments_metric": facts.comment_metrics(
            comments, posts.drop("dt"), day_column="dt", compat_uuid=compat_uuid
        ),
        "tb_keywords": facts.keyword_facts(
            staging["sentences"], staging["keywords"], posts, comments, day_column="dt"
        ),
    }
    for name, df in new_facts.items():
        with replaced_partitions(spark, f"{mart}/{name}", days, cars, day_column="ingestion_date"):
            append_facts(df, f"{mart}/{name}")


def create_fact_tables(spark: SparkSession, mart: str) -> None:
    """Catalog entries over the fact folders, for SQL users of the mart."""
    for name in ("tb_posts_metric", "tb_comments_metric", "tb_keywords"):
        spark.sql(MART[name].ddl(f"{mart}/{name}"))
        spark.catalog.recoverPartitions(name)


def read_fact(spark: SparkSession, mart: str, name: str) -> DataFrame:
    return spark.read.schema(MART[name].schema).parquet(f"{mart}/{name}").select(*MART[name].columns)


def dimensions_digest(cars: DataFrame, sources: DataFrame) -> str:
    """A digest of the rows of both small dimensions, in any order."""
    parts = []
    for df in (cars, sources):
        row = F.xxhash64(*(F.struct(F.lit(c), F.col(c)) for c in sorted(df.columns)))
        sums = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row)).first()
        parts.append(":".join(map(str, sums)))
    return "|".join(parts)


def read_view(spark: SparkSession, mart: str, name: str, days: Sequence[str] | None = None) -> DataFrame:
    """An analysis view, all days or some; empty before the first refresh."""
    return versions.read_units(spark, f"{mart}/{name}", VIEWS[name].schema, days)


def _facts_of(spark: SparkSession, mart: str, name: str, days: Sequence[str], cars: Sequence[str] | None = None) -> DataFrame:
    if not path_exists(spark, f"{mart}/{name}"):
        return spark.createDataFrame([], MART[name].schema)
    mine = F.col("ingestion_date").isin(*(date.fromisoformat(d) for d in days))
    return read_fact(spark, mart, name).filter(mine if cars is None else mine & F.col("car_name").isin(*cars))


@contextmanager
def recorded_changes(spark: SparkSession, mart: str, days: Sequence[str], cars: Sequence[str] | None = None) -> Iterator[str]:
    """Around the writing of facts: the (day, post) whose metric facts it changes, at the path given.

    Only the run's own partitions are read, once before and once after. The table is there after the block.
    """
    run = f"{mart}/changes/{uuid.uuid4().hex}"
    both = lambda: views.fact_fingerprints(
        *(_facts_of(spark, mart, n, days, cars) for n in ("tb_posts_metric", "tb_comments_metric"))
    )
    both().write.parquet(f"{run}/before")
    yield f"{run}/posts"
    before = spark.read.parquet(f"{run}/before")
    views.changed_posts(before, both()).write.parquet(f"{run}/posts")
    drop_folder(spark, f"{run}/before")


def refresh_views(
    spark: SparkSession,
    mart: str,
    cars: DataFrame,
    sources: DataFrame,
    days: Sequence[str] | None = None,
    same_day: bool = True,
    changed: DataFrame | None = None,
) -> None:
    """Bring both views up to date.

    Views are stored by day, in versions. A listening row depends on one keyword fact and the dimensions only; with
    ``days`` those days are drawn anew. A row of the same-day attention view depends on the facts of one day and post;
    with ``changed``, the (ingestion_date, post_id) whose facts are different now, only the days they name are read and
    written, and only their rows are drawn anew. With each view a digest of the small dimensions and its form is kept:
    where it differs, or without ``days`` or ``changed``, the view is built as a whole.

    ``same_day=False`` gives the attention view's full form, in which all snapshots of a post meet all snapshots of its
    comments; it is always built as a whole, and its rows per post grow with the square of the days loaded.
    """
    digest = dimensions_digest(cars, sources)
    listening, attention = f"{mart}/vw_social_listening", f"{mart}/vw_social_attention"
    day = F.col("ingestion_date").cast("string")
    if days is not None and _made_with(spark, listening) == digest:
        keywords = _facts_of(spark, mart, "tb_keywords", days)
        versions.replace_units(views.social_listening(keywords, cars, sources), listening, day, days)
    else:
        whole = views.social_listening(read_fact(spark, mart, "tb_keywords"), cars, sources)
        versions.replace_units(whole, listening, day)
        _mark(spark, listening, digest)
    form = f"{digest}|{'same day' if same_day else 'all snapshots'}"
    names = ("tb_posts_metric", "tb_comments_metric")
    if same_day and changed is not None and _made_with(spark, attention) == form:
        touched = sorted(str(r["ingestion_date"]) for r in changed.select("ingestion_date").distinct().collect())
        if touched:
            rows = views.apply_changes(
                read_view(spark, mart, "vw_social_attention", touched),
                changed,
                *(_facts_of(spark, mart, n, touched) for n in names),
                cars,
                sources,
            )
            versions.replace_units(rows, attention, day, touched)
    else:
        whole = views.social_attention(*(read_fact(spark, mart, n) for n in names), cars, sources, same_day)
        versions.replace_units(whole, attention, day)
        _mark(spark, attention, form)


def _made_with(spark: SparkSession, view: str) -> str | None:
    """What the view was made with; None where it has no version."""
    if not versions.has_versions(spark, view):
        return None
    row = read_snapshot(spark, f"{view}/made_with", T.StructType([T.StructField("digest", T.StringType())])).first()
    return row and row["digest"]


def _mark(spark: SparkSession, view: str, digest: str) -> None:
    mark = f"{view}/made_with"
    write_snapshot(spark.range(1).select(F.lit(digest).alias("digest")), mark, next_snapshot_id(spark, mark))
    drop_snapshots(spark, mark, snapshot_ids(spark, mark)[:-1])


def load_days(
    spark: SparkSession,
    staging_base: str,
    mart: str,
    car_dim: DataFrame,
    source_dim: DataFrame,
    first: str | date,
    last: str | date | None = None,
    cars: Sequence[str] | None = None,
    same_day: bool = True,
) -> None:
    """Dimensions, then facts, then views, for one day or a range of days, of all or some cars.

    Days and cars may come in any order and again; the end result is the same.
    """
    check_parameters(staging_base=staging_base, mart=mart, first=first)
    days = days_between(first, last)
    arriving = sum(scope_bytes(spark, f"{staging_base}/{d}", days, cars) for d, _ in STAGING_DIRS.values())
    with sized_shuffles(spark, max([arriving, *(stored_bytes(spark, f"{mart}/{name}/data") for name in DIMENSION_KEYS)])):
        staging = read_staging_days(spark, staging_base, days, cars)
        upsert_dimensions(spark, staging, mart)
        with recorded_changes(spark, mart, days, cars) as changes:
            append_day_facts(spark, staging, mart, days, cars)
        changed = spark.read.schema("ingestion_date date, post_id string").parquet(changes)
        refresh_views(spark, mart, car_dim, source_dim, days, same_day, changed)
        drop_folder(spark, changes.rsplit("/", 1)[0])
