"""Named queries over the given tables, each next to the SQL that checks it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from talkmart.functions import text as X
from talkmart.session import removed_shuffles
from talkmart.sources.writers import drop_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The load day of every query that stamps or keys rows.
RUN_DATE = "2024-02-01"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: in the checkpoint folder, where none is set in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _stored_at(path: str, df: DataFrame) -> DataFrame:
    with removed_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a new shared folder and read back, for what several steps of a query read."""
    return _stored_at(scratch_folder(df.sparkSession, name), df)


def stored_steps() -> Callable[..., DataFrame]:
    """``step(df, name, over)``: ``stored`` for the steps of one job. The step named by ``over`` is read no more: its files go."""
    paths: dict[str, str] = {}

    def step(df: DataFrame, name: str, over: str | None = None) -> DataFrame:
        paths[name] = scratch_folder(df.sparkSession, name)
        kept = _stored_at(paths[name], df)
        if over is not None:
            drop_folder(df.sparkSession, paths.pop(over))
        return kept

    return step


def sql_key(*parts: str) -> str:
    """SQL text of ``functions.keys.stable_key``."""
    marked = [
        f"coalesce(length(CAST({p} AS VARCHAR)) || ':' || CAST({p} AS VARCHAR), '-')" for p in parts
    ]
    return f"md5(concat_ws('|', {', '.join(marked)}))"


def sql_epoch(ts: str) -> str:
    return f"CAST(floor(epoch_us({ts}) / 1000000) AS BIGINT)"


def sql_clean(expression: str) -> str:
    """SQL text of ``functions.text.clean`` for an engine without back-references."""
    out = f"lower({expression})"
    for pattern in (X.URL, X.MENTION, X.HASHTAG, X.QUOTES_AND_BRACKETS):
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    for mark in ".!?,~":
        out = f"regexp_replace({out}, '[{mark}]{{2,}}', '{mark}', 'g')"
    invisible = r"[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FEFF}\x{00A0}]"
    out = f"regexp_replace({out}, '{invisible}', '', 'g')"
    return rf"trim(regexp_replace({out}, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ')"


def sql_bucket(expression: str, n: int) -> str:
    """SQL text of the md5 bucket used for shards and files."""
    return f"CAST(CAST('0x' || substr(md5(CAST({expression} AS VARCHAR)), 1, 7) AS BIGINT) % {n} AS INTEGER)"


_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, sql: str, needs: tuple[str, ...] = ()) -> None:
    _CTES[name] = (needs, sql)


def with_ctes(select: str, *names: str) -> str:
    """``select`` with the named common table expressions and what they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _CTES[name][0]:
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    # Each is worked out once, however many others use it.
    parts = ",\n".join(f"{name} AS MATERIALIZED ({_CTES[name][1]})" for name in order)
    return f"WITH {parts}\n{select}"
