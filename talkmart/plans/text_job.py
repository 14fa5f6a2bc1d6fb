"""The daily text job: raw records to posts, comments and clean sentences."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmart.functions import text as X
from talkmart.functions.timefn import SEOUL, as_date, to_local_date, within_days
from talkmart.operators import normalize, quarantine
from talkmart.operators.selection import check_parameters
from talkmart.schemas import RAW
from talkmart.session import sized_shuffles
from talkmart.sources.writers import path_exists, replaced_partitions, scope_bytes, write_partitions

PARTITIONS = ("dt", "car_name")


def days_between(first: str | date, last: str | date | None = None) -> list[str]:
    start, end = as_date(first), as_date(last if last is not None else first)
    return [(start + timedelta(days=n)).isoformat() for n in range((end - start).days + 1)]


def scope(days: Sequence[str], cars: Sequence[str] | None = None) -> Column:
    """Filter on the partition columns: only the days and cars of this run are read."""
    inside = F.col("dt").between(F.lit(days[0]).cast("date"), F.lit(days[-1]).cast("date"))
    return inside if cars is None else inside & F.col("car_name").isin(*cars)


def read_raw_days(
    spark: SparkSession, root: str, days: Sequence[str], json_lines: bool = False
) -> DataFrame:
    """Raw records under ``root/dt=<day>`` with their day; days without a folder are skipped."""
    paths = [f"{root}/dt={day}" for day in days if path_exists(spark, f"{root}/dt={day}")]
    schema = T.StructType([*RAW.fields, T.StructField("dt", T.DateType())])
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", root).option("multiLine", not json_lines)
    return reader.json(paths)


def numbered_records(raw: DataFrame) -> DataFrame:
    """Adds ``record_digest`` and ``record_no``, which tell records of one day and id apart.

    The digest is of the whole record; only equal records of a day get different
    numbers. Neither depends on what else a run reads or how it is partitioned,
    so a rerun, also of one car, gives each record its old key.
    """
    digested = raw.withColumn("record_digest", F.md5(F.to_json(F.struct(*(raw[c] for c in raw.columns)))))
    alike = Window.partitionBy("dt", "id", "record_digest").orderBy("record_digest")
    return digested.withColumn("record_no", F.row_number().over(alike))


def run_text_job(
    spark: SparkSession,
    raw: DataFrame,
    out: str,
    first: str | date,
    last: str | date | None = None,
    cars: Sequence[str] | None = None,
    files: int | None = None,
    script: str = X.HANGUL,
    zone: str = SEOUL,
) -> None:
    """Raw records with ``dt`` -> the tables of one day, or of all days ``first`` .. ``last``.

    Raw JSON is parsed once and landed as Parquet together with its reject reasons
    and a digest. All later steps read written tables, so a lost executor costs one
    task, not the job; keys depend on the records alone.

    A rerun replaces the (day, car) partitions of its scope. ``files`` fixes the
    number of sentence files; otherwise their size decides.
    """
    check_parameters(out=out, first=first)
    days = days_between(first, last)
    inside = scope(days, cars)

    def replace(df: DataFrame, table: str) -> DataFrame:
        """Write the scope's partitions and give back what was written."""
        with replaced_partitions(spark, f"{out}/{table}", days, cars):
            write_partitions(df, f"{out}/{table}", PARTITIONS)
        return spark.read.schema(df.schema).parquet(f"{out}/{table}").filter(inside)

    judged = numbered_records(raw.filter(inside)).withColumn("reject_reasons", quarantine.reject_reasons(raw.drop("dt")))
    landed = replace(judged, "landed")
    with sized_shuffles(spark, scope_bytes(spark, f"{out}/landed", days, cars)):
        _split(spark, landed, out, days, cars, replace, files, script, zone)


def _split(
    spark: SparkSession,
    landed: DataFrame,
    out: str,
    days: Sequence[str],
    cars: Sequence[str] | None,
    replace: Callable[[DataFrame, str], DataFrame],
    files: int | None,
    script: str,
    zone: str,
) -> None:
    """Rejects, posts, comments and sentences out of the landed records."""
    rejected = F.size("reject_reasons") > 0
    replace(landed.filter(rejected).drop("record_digest", "record_no"), "failed_raw")

    position = ["record_digest", "record_no"]
    keyed = normalize.with_post_key(landed.filter(~rejected), F.col("dt").cast("string"), position)
    posts = replace(normalize.post_rows(keyed, carry=["dt"]), "post_data")
    comments = replace(normalize.comment_rows(keyed, carry=PARTITIONS), "comment_data")

    # The bounds of the whole run reach the scan; the day itself is a column.
    created = F.col("create_timestamp")
    fresh = within_days(created, days[0], days[-1], zone) & (to_local_date(created, zone) == F.col("dt"))
    sentences = normalize.sentence_rows(posts.filter(fresh), comments.filter(fresh), carry=PARTITIONS)
    clean = X.clean_sentences(sentences, script=script)
    if files is None:
        replace(clean, "sentence_data")
    else:
        spread = clean.repartition(files)
        with replaced_partitions(spark, f"{out}/sentence_data", days, cars):
            spread.write.mode("append").partitionBy(*PARTITIONS).parquet(f"{out}/sentence_data")
