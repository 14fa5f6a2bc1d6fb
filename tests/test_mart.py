"""Dedupe, merge, facts, views."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from talkmart.operators import facts, upsert, views
from talkmart.plans.queries import QUERIES, SQL, registry
from talkmart.sources import versions
from tests.compare import mismatch
from tests.conftest import plan_of

POSTS = "post_uuid string, post_id string, title string, author string, article string, create_timestamp bigint, like_cnt bigint, dislike_cnt bigint, view_cnt bigint, comment_cnt bigint, car_name string, source string"
DIM = "post_id string, title string, author string, article string, create_date date"


def post(uuid, id_, when=0, car="Kona", source="clien", title="t", likes=1):
    return (uuid, id_, title, "a", "x", when, likes, 0, 9, 2, car, source)


def test_latest_is_the_newest_whatever_the_partitioning(spark):
    rows = [post("u", "p", when, title=title) for when in (1, 5) for title in ("b", "a", "c")] + [post("v", "q")]
    for parts in (1, 5):
        kept = upsert.latest_per_key(spark.createDataFrame(rows, POSTS).repartition(parts), ["post_id"])
        assert sorted((r.post_id, r.create_timestamp, r.title) for r in kept.collect()) == [("p", 5, "a"), ("q", 0, "t")]
    # One row per key and task goes into the shuffle.
    assert plan_of(upsert.latest_per_key(spark.createDataFrame(rows, POSTS), ["post_id"])).count("WindowGroupLimit") == 2


def test_merge_posts(spark):
    old = [("p", "old", "a", "x", date(2025, 1, 1)), ("kept", "old", "a", "x", date(2025, 1, 1))]
    target = spark.createDataFrame(old, DIM)
    incoming = upsert.posts_to_load(
        spark.createDataFrame([post("1", "p", 1738335600, title="new"), post("2", "n", 1738335599)], POSTS)
    )
    expected = [
        ("kept", "old", date(2025, 1, 1)), ("n", "t", date(2025, 1, 31)), ("p", "new", date(2025, 2, 1)),
    ]
    for small in (False, True):
        merged = upsert.merge_posts(target, incoming, small_source=small)
        assert sorted((r.post_id, r.title, r.create_date) for r in merged.collect()) == expected
        assert merged.columns == target.columns
        twice = upsert.merge_posts(merged, incoming, small_source=small)
        assert Counter(twice.collect()) == Counter(merged.collect())
    # The small form moves no row of the target.
    plan = plan_of(upsert.merge_posts(target, incoming, small_source=True))
    assert "FullOuter" not in plan and plan.count("BroadcastHashJoin") >= 2


@pytest.fixture
def folder(spark, tmp_path):
    orders, lines = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_shipdate timestamp, l_discount double, l_quantity double"
    day = datetime(1996, 1, 1)
    tables = {
        "orders": spark.createDataFrame([(i, i % 2, "O", 10.0, day, "1") for i in range(6)], orders),
        "lineitem": spark.createDataFrame([(i % 8, i, i, i, "RNA"[i % 3], day, 0.1, 5.0) for i in range(20)], lines),
        "customer": spark.createDataFrame([(i, f"c{i}", "seg", 1) for i in range(2)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey long"),
        "nation": spark.createDataFrame([(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(1, "R")], "r_regionkey int, r_name string"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_a_load_that_is_not_small_is_not_broadcast(spark, folder, monkeypatch):
    small = {name: QUERIES[name](spark, folder) for name in ("upsert_posts_small", "upsert_late_days")}
    monkeypatch.setattr(upsert, "SMALL_SOURCE_BYTES", 10)
    for name, joins in (("upsert_posts_small", 1), ("upsert_late_days", 2)):
        large = QUERIES[name](spark, folder)
        assert plan_of(large).count("FullOuter") == joins and "FullOuter" not in plan_of(small["upsert_posts_small"])
        assert Counter(large.collect()) == Counter(small[name].collect()) != Counter()


@pytest.mark.parametrize("name, scans", [("attention_changes", 0), ("constraint_report", 1)])
def test_metric_facts_are_made_once(spark, folder, name, scans):
    """What several passes read is stored: the plan that is left does not make the facts from the line items again."""
    plan = plan_of(QUERIES[name](spark, folder))
    assert plan.count("FileScan parquet [l_orderkey") == scans


def test_a_load_into_versions_is_made_once(spark, folder, monkeypatch):
    plans, upsert_keyed = [], versions.upsert_keyed
    monkeypatch.setattr(versions, "upsert_keyed", lambda load, *more, **options: plans.append(plan_of(load)) or upsert_keyed(load, *more, **options))
    plain, stored = QUERIES["upsert_late_days"](spark, folder), QUERIES["upsert_versions"](spark, folder)
    assert Counter(stored.select(*plain.columns).collect()) == Counter(plain.collect()) != Counter()
    assert len(plans) == 3 and not any("Window" in plan for plan in plans)


def test_merge_comments_never_updates_the_post(spark):
    schema = "post_id string, comment_id string, author string, content string, create_date date"
    day = date(2025, 1, 1)
    target = spark.createDataFrame([("p", "c1", "a", "old", day), (None, "c3", "a", "old", day)], schema)
    source = spark.createDataFrame([("other", "c1", "b", "new", day), ("q", "c2", "b", None, day), ("z", "c3", "b", "new", day)], schema)
    for small in (False, True):
        rows = {r.comment_id: (r.post_id, r.content) for r in upsert.merge_comments(target, source, small_source=small).collect()}
        assert rows == {"c1": ("p", "new"), "c2": ("q", None), "c3": (None, "new")}
        keyed = upsert.merge_comments(target, source, ("post_id", "comment_id"), small_source=small)
        assert keyed.count() == 5


def _staged(spark):
    posts = spark.createDataFrame([post("u1", "p1"), post("u2", "p2", source="unknown"), post("u3", "p3", likes=None)], POSTS)
    comments = spark.createDataFrame(
        [("u1", "k1", "p1_a", "w", "hello", 0, 4, 1), ("u1", "k2", "p1_b", "w", "again", 0, None, 2), ("u2", "k3", "p2_a", "w", "x", 0, 1, 1)],
        "post_uuid string, comment_uuid string, comment_id string, author string, content string, create_timestamp bigint, like_cnt bigint, dislike_cnt bigint",
    )
    return posts, comments


def _dims(spark):
    cars = spark.createDataFrame([("Kona", None, date(2025, 2, 1))], "car_name string, pre_car_name string, release_date date")
    return cars, spark.createDataFrame([("clien", "30s")], "source string, age string")


def test_facts_and_attention(spark):
    posts, comments = _staged(spark)
    cars, sources = _dims(spark)
    p = facts.post_metrics(posts, "2025-02-02")
    c = facts.comment_metrics(comments, posts, "2025-02-02")
    assert {r.comment_id for r in c.collect()} == {"p1_a", "p1_b", "p2_a"}
    assert {r.comment_id for r in facts.comment_metrics(comments, posts, "2025-02-02", compat_uuid=True).collect()} == {"k1", "k2", "k3"}
    attention = views.social_attention(p, c, cars, sources)
    rows = {(r.post_id, r.comment_id): (r.like_cnt, r.dislike_cnt, r.view_cnt) for r in attention.collect()}
    # A NULL comment counter stays NULL; a post without comments shows its own.
    assert rows == {("p1", "p1_a"): (4, 1, 9), ("p1", "p1_b"): (None, 2, 9), ("p3", None): (None, 0, 9)}
    plain = (
        p.alias("p").join(c.alias("c"), "post_id", "left").join(cars, F.col("p.car_name") == cars.car_name)
        .join(sources, F.col("p.source") == sources.source)
    )
    assert plain.count() == attention.count()


def test_attention_over_two_days(spark):
    posts, comments = _staged(spark)
    cars, sources = _dims(spark)
    days = ("2025-02-02", "2025-02-03")
    p = facts.post_metrics(posts, days[0]).unionByName(facts.post_metrics(posts, days[1]))
    c = facts.comment_metrics(comments, posts, days[0]).unionByName(facts.comment_metrics(comments, posts, days[1]))
    # Every post snapshot meets every comment snapshot, unless limited to one day.
    assert views.social_attention(p, c, cars, sources).filter("post_id = 'p1'").count() == 8
    assert views.social_attention(p, c, cars, sources, same_day=True).filter("post_id = 'p1'").count() == 4
    view = views.social_attention(p, c, cars, sources)
    expected = view.groupBy("ingestion_date").agg(
        F.count("comment_id").alias("n"), F.sum(F.coalesce("like_cnt", F.lit(0))).alias("likes")
    )
    got = views.attention_daily(p, c, cars, sources, by=["ingestion_date"])
    assert sorted((r.ingestion_date, r.comment_rows, r.likes) for r in got.collect()) == sorted(
        (r.ingestion_date, r.n, r.likes) for r in expected.collect()
    )


def test_a_comment_row_without_id_shows_the_post(spark):
    posts, _ = _staged(spark)
    cars, sources = _dims(spark)
    p = facts.post_metrics(posts.filter("post_id = 'p1'"), "2025-02-02")
    c = spark.createDataFrame([("p1", None, "Kona", "clien", 77, 78, date(2025, 2, 2))], "post_id string, comment_id string, car_name string, source string, like_cnt bigint, dislike_cnt bigint, ingestion_date date")
    row = views.social_attention(p, c, cars, sources).first()
    assert (row.comment_id, row.like_cnt, row.dislike_cnt) == (None, 1, 0)
    total = views.attention_daily(p, c, cars, sources).first()
    assert (total.likes, total.comment_rows) == (1, 0)


def test_keyword_facts_and_listening(spark):
    posts, comments = _staged(spark)
    cars, sources = _dims(spark)
    sentences = spark.createDataFrame(
        [("u1", None, "s1", "post", "one"), ("u1", "k1", "s2", "comment", "two"), ("u1", "gone", "s3", "comment", "three"),
         ("u2", None, "s4", "post", "four"), ("u1", None, "s5", "post", "unscored")],
        "post_uuid string, comment_uuid string, sentence_uuid string, type string, sentence string",
    )
    scored = spark.createDataFrame(
        [(f"s{i}", i / 10, "기능", "연비") for i in range(1, 5)],
        "sentence_uuid string, sentiment_score double, category string, keyword string",
    )
    rows = facts.keyword_facts(sentences, scored, posts, comments, "2025-01-15")
    assert sorted((r.sentence, r.post_id, r.comment_id) for r in rows.collect()) == sorted(
        [("one", "p1", None), ("two", "p1", "p1_a"), ("three", "p1", None), ("four", "p2", None)], key=str
    )
    listening = views.social_listening(rows, cars, sources)
    assert {r.sentence for r in listening.collect()} == {"one", "two", "three"}
    assert len(listening.columns) == 13
    before = views.facelift_sentiment(listening).collect()
    assert [(r.phase, r.sentences, r.avg_sentiment) for r in before] == [("before", 3, 0.6 / 3)]
    total = views.facelift_sentiment(listening, ("age",), subtotals=True)
    assert total.count() == 3
    shift = views.keyword_shift(listening).first()
    assert (shift.n_before, shift.n_after, shift.avg_after) == (3, 0, None)


def test_many_posts_without_comment_do_not_meet_in_one_partition(spark):
    posts, comments = _staged(spark)
    sentences = spark.range(400).select(
        F.lit("u1").alias("post_uuid"), F.lit(None).cast("string").alias("comment_uuid"),
        F.concat(F.lit("s"), "id").alias("sentence_uuid"), F.lit("post").alias("type"), F.lit("x").alias("sentence"),
    )
    scored = sentences.select("sentence_uuid", F.lit(0.5).alias("sentiment_score"), F.lit("c").alias("category"), F.lit("k").alias("keyword"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = facts.keyword_facts(sentences, scored, posts, comments, "2025-01-15")
        sizes = rows.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 4 and sum(r["count"] for r in sizes) == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_keyword_facts_join_packed_keys(spark):
    """Keys that only look alike stay apart, repeated and NULL ones count as in a plain join, and 16 bytes are moved for an md5."""
    hexed = "00112233445566778899aabbccddee0"
    keys = [hexed + "f", (hexed + "f").upper(), hexed, hexed + "f\n", hexed + "f" + "0" * 34, "k" * 16, "", "ä", None, hexed + "f"]
    named = spark.createDataFrame(list(enumerate(keys)), "n int, k string")
    sentences = named.select(F.col("k").alias("post_uuid"), F.col("k").alias("comment_uuid"), F.col("k").alias("sentence_uuid"), F.lit("comment").alias("type"), F.col("n").cast("string").alias("sentence"))
    own = sentences.withColumn("comment_uuid", F.lit(None).cast("string"))
    scored = named.select(F.col("k").alias("sentence_uuid"), F.lit(0.5).alias("sentiment_score"), F.lit("c").alias("category"), F.lit("k").alias("keyword"))
    posts = named.select(F.col("k").alias("post_uuid"), F.concat(F.lit("p"), "n").alias("post_id"), F.lit("Kona").alias("car_name"), F.lit("clien").alias("source"))
    comments = named.select(F.col("k").alias("comment_uuid"), F.concat(F.lit("c"), "n").alias("comment_id"))
    rows = facts.keyword_facts(sentences.unionByName(own), scored, posts, comments, "2025-01-15")
    got = sorted((r.sentence, r.post_id, r.comment_id or "") for r in rows.collect())
    twins = [[j for j, other in enumerate(keys) if other == key and key is not None] for key in keys]
    want = [(str(i), f"p{p}", c) for i, same in enumerate(twins) for _ in same for p in same for c in [*(f"c{j}" for j in same), ""]]
    assert got == sorted(want)
    plan = plan_of(rows)
    assert "unhex(" in plan and "post:" not in plan


def _shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}


def _listened_tables(spark, folder):
    """Orders of two customers with their line items, one of them twice, and one that no customer has."""
    day = F.lit("1997-03-01 10:00:00").cast("timestamp_ntz")
    tables = {
        "region": spark.createDataFrame([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(0, "KONA", 0), (1, "NIRO", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": spark.range(2).select(
            F.col("id").alias("c_custkey"), F.concat(F.lit("Customer#"), "id").alias("c_name"), F.lit("BUILDING").alias("c_mktsegment"), F.col("id").cast("int").alias("c_nationkey")
        ),
        "orders": spark.range(30).select(
            F.col("id").alias("o_orderkey"), (F.col("id") % 3).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(12.5).alias("o_totalprice"), F.lit("1-URGENT").alias("o_orderpriority"), day.alias("o_orderdate")
        ),
        "lineitem": spark.range(121).select(
            (F.col("id") % 120 % 40).alias("l_orderkey"), (F.col("id") % 120).cast("int").alias("l_linenumber"), (F.col("id") % 120).alias("l_partkey"), F.lit(7).cast("bigint").alias("l_suppkey"),
            F.lit("R").alias("l_returnflag"), F.lit(0.0).alias("l_discount"), F.lit(1.0).alias("l_quantity"), day.alias("l_shipdate"),
        ),
    }
    duck = duckdb.connect()
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return duck


def test_keyword_facts_in_steps_are_those_of_one_plan(spark, tmp_path):
    """Keys that come twice or are NULL, on every side."""
    keys = ["a", "b", "b", "0" * 32, None, "gone"]
    named = spark.createDataFrame(list(enumerate(keys)), "n int, k string")
    sentences = named.select(F.col("k").alias("post_uuid"), F.col("k").alias("comment_uuid"), F.col("k").alias("sentence_uuid"), F.when(F.col("n") % 2 == 0, "post").otherwise("comment").alias("type"), F.col("n").cast("string").alias("sentence"))
    sentences = sentences.unionByName(sentences.withColumn("comment_uuid", F.lit(None).cast("string")))
    scored = named.select(F.col("k").alias("sentence_uuid"), (F.col("n") / 10).alias("sentiment_score"), F.lit("c").alias("category"), F.lit("k").alias("keyword"))
    posts = named.select(F.col("k").alias("post_uuid"), F.concat(F.lit("p"), "n").alias("post_id"), F.lit("Kona").alias("car_name"), F.lit("clien").alias("source"))
    comments = named.filter("n <> 5").select(F.col("k").alias("comment_uuid"), F.concat(F.lit("c"), "n").alias("comment_id"))
    over = {}

    def step(rows, name, **done):
        over[name] = done
        rows.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    plain = facts.keyword_facts(sentences, scored, posts, comments, "2025-01-15")
    stepped = facts.keyword_facts(sentences, scored, posts, comments, "2025-01-15", step=step)
    assert plain.dtypes == stepped.dtypes and plain.count() == 2 * 3 + 8 + 16
    assert Counter(plain.collect()) == Counter(stepped.collect())
    assert over == {"of_posts": {}, "scored": {}, "owned": {"over": "scored"}}


@pytest.mark.parametrize("name", ["append_keywords", "social_listening"])
def test_keyword_queries_keep_the_files_of_one_step_only(spark, tmp_path, monkeypatch, name):
    """When a step is written its shuffles go, and the files of the step before that nothing reads any more."""
    monkeypatch.setattr(registry, "scratch_folder", lambda _, name: f"{tmp_path}/kept/{name}")
    duck = _listened_tables(spark, str(tmp_path))
    before, threshold = _shuffle_files(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = QUERIES[name](spark, str(tmp_path))
        assert sorted(p.name for p in (tmp_path / "kept").iterdir()) == ["of_posts", "owned", "posts"]
        assert _shuffle_files(spark) <= before
        assert mismatch(rows, duck, SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_hot_post_is_split_over_tasks(spark):
    """A third of all comments on one post: the join splits them, and the result is whole."""
    hot = spark.range(120_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 4000).alias("n"), "id")
    comments = hot.select(
        F.concat(F.lit("u"), "n").alias("post_uuid"), F.concat(F.lit("k"), "id").alias("comment_uuid"),
        F.concat(F.lit("c"), "id").alias("comment_id"), F.sha2(F.col("id").cast("string"), 256).alias("content"),
        F.col("id").alias("like_cnt"), F.lit(1).alias("dislike_cnt"),
    ).repartition(8)
    posts = spark.range(4000).select(
        F.concat(F.lit("u"), "id").alias("post_uuid"), F.concat(F.lit("p"), "id").alias("post_id"),
        F.lit("Kona").alias("car_name"), F.lit("clien").alias("source"), *(F.lit(1).cast("bigint").alias(c) for c in ("like_cnt", "dislike_cnt", "view_cnt", "comment_cnt")),
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) if k != "spark.sql.adaptive.autoBroadcastJoinThreshold" else None for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        metrics = facts.comment_metrics(comments, posts, "2025-02-02")
        rows = metrics.collect()
        assert len(rows) == 120_000 and len({r.comment_id for r in rows}) == 120_000
        assert "skew=true" in plan_of(metrics)
        view = views.social_attention(facts.post_metrics(posts, "2025-02-02"), metrics, *_dims(spark))
        assert len(view.collect()) == 120_000 + 4000 - metrics.select("post_id").distinct().count()
        assert plan_of(view).count("skew=true") >= 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
