"""Work lists: tags, top-k, shards, windows, retries."""

from __future__ import annotations

import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from talkmart.functions import timefn
from talkmart.operators import recovery, selection
from tests.conftest import plan_of


def test_alias_tags(spark):
    df = spark.createDataFrame([("싼타페와 산타페",), ("그랜저 vs 쏘나타",), ("none",)], "text string")
    rows = sorted((r.text, r.car_name) for r in selection.tag_by_alias(df, "text").collect())
    assert rows == [("그랜저 vs 쏘나타", "Grandeur"), ("그랜저 vs 쏘나타", "Sonata"), ("싼타페와 산타페", "Santafe")]
    assert "Join" not in plan_of(selection.tag_by_alias(df, "text"))


def test_stride_shards_against_brute_force(spark):
    ids = [f"v{i % 137}" for i in range(1000)]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    ordered = sorted(set(ids), key=lambda i: (hashlib.md5(i.encode()).hexdigest(), i))
    expected = {i: (n, n % 10) for n, i in enumerate(ordered)}
    for digits in (1, 3):
        got = selection.stride_shards(df, "id", 10, digits).collect()
        assert {r.id: (r.position, r.shard) for r in got} == expected
        assert len(got) == 137
    # Shard k holds exactly ordered[k::10].
    assert [i for i in ordered if expected[i][1] == 3] == ordered[3::10]


def test_top_per_group_keeps_k_rows_per_task(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), "id")
    top = selection.top_per_group(df, ["g"], [F.col("id").desc()], 5)
    assert plan_of(top).count("WindowGroupLimit") == 2
    assert sorted(r.id for r in top.filter("g = 0").collect()) == [1986, 1989, 1992, 1995, 1998]


def test_small_helpers(spark):
    df = spark.createDataFrame([("bobae",), ("other",)], "source string")
    assert [r.source for r in selection.only_sources(df).collect()] == ["bobae"]
    with pytest.raises(ValueError, match="car_name"):
        selection.check_parameters(input_date="2025-01-01", car_name="")
    ids = spark.range(100)
    assert selection.validation_sample(ids, "id").count() == 10
    assert selection.validation_sample(ids.repartition(7), "id").collect() == selection.validation_sample(ids, "id").collect()
    shards = ids.select(selection.hash_shard(F.col("id"), 4).alias("s")).distinct().count()
    assert shards == 4


def test_windows(spark):
    days = spark.createDataFrame([(d,) for d in ("2025-01-23", "2025-01-24", "2025-01-31", "2025-02-01")], "d string")
    kept = days.filter(timefn.within_lookback(F.col("d"), "2025-01-31"))
    assert [r.d for r in kept.collect()] == ["2025-01-24", "2025-01-31"]
    as_dates = days.select(F.col("d").cast("date").alias("d"))
    assert as_dates.filter(timefn.within_lookback(F.col("d"), date(2025, 1, 31))).count() == 2


def test_day_filter_reaches_the_parquet_scan(spark, tmp_path):
    spark.range(10).select(F.col("id").cast("int").alias("create_timestamp"), F.lit("x").alias("wide")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).filter(timefn.within_days(F.col("create_timestamp"), "2025-02-01"))
    plan = plan_of(df.select("create_timestamp"))
    assert "PushedFilters: [IsNotNull(create_timestamp), GreaterThanOrEqual(create_timestamp,1738335600)" in plan
    assert "create_timestamp#" in plan and "<= 1738421999" in plan
    assert "wide" not in plan


def test_recovery(spark):
    attempted = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "url string")
    done = spark.createDataFrame([("a",), ("a",)], "url string")
    assert sorted(r.url for r in recovery.pending(attempted, done, "url").collect()) == ["b", "c"]
    lists = [spark.createDataFrame([(" x ",), ("y",), ("",)], "a string"), spark.createDataFrame([("x",)], "b string")]
    assert sorted(r.target for r in recovery.merged_failures(*lists).collect()) == ["x", "y"]
    attempts = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new")], "k string, n int, v string")
    assert recovery.latest_attempt(attempts, ["k"], [F.col("n").desc()]).first().v == "new"
