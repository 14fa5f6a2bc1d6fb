"""Quarantine, splitting, nesting, sentences."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from talkmart.functions.keys import stable_key
from talkmart.operators import normalize, quarantine
from talkmart.schemas import RAW

DAY = "2025-02-01"


def record(id_, comments=(), **changes):
    base = {
        "car_name": "Kona", "source": "clien", "id": id_, "title": f"title {id_}", "nickname": "n", "article": "a\nb\n",
        "view_count": 3, "like_count": 2, "dislike_count": 1, "date": 1738335600,
        "comment_count": len(comments),
        "comments": [
            {"comment_content": text, "comment_nickname": who, "comment_date": 1738335600 + i,
             "comment_like_count": i, "comment_dislike_count": 0}
            for i, (who, text) in enumerate(comments)
        ],
    }
    return {**base, **changes}


def raw(spark, *records):
    return spark.createDataFrame(list(records), RAW)


def test_quarantine(spark):
    bad = record("p3", like_count=-1, view_count=None)
    df = raw(spark, record("p1"), record("p2") | {"comments": None}, bad, bad, record("p4", title=None))
    good, rejected = quarantine.good_rows(df), quarantine.rejected_rows(df)
    assert [r.id for r in good.collect()] == ["p1"]
    assert good.count() + rejected.count() == df.count()
    reasons = {r.id: r.reject_reasons for r in rejected.collect()}
    assert reasons["p3"] == ["view_count missing", "like_count negative"]
    assert reasons["p2"] == ["comments missing"]
    assert rejected.filter("id = 'p3'").count() == 2
    same = quarantine.rejected_distinct(df).collect()
    assert Counter(r.id for r in same) == Counter(r.id for r in df.subtract(good).collect())
    assert Counter(r.id for r in same)["p3"] == 1


def test_not_a_number_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert quarantine.good_rows(df, ()).count() == df.dropna().count() == 1


def test_blank_comments(spark):
    df = raw(spark, record("p", [("u", "x"), (None, "y"), ("v", None)]))
    assert [c.comment_content for c in quarantine.drop_blank_comments(df).first().comments] == ["x"]


def test_split(spark):
    df = raw(
        spark,
        record("p1", [("u", "hello"), ("v", "there")]),
        record("p2", [("u", "lost")], comment_count=0),
        record("p3", comment_count=4),
    )
    posts, comments = normalize.split_records(df, DAY)
    assert posts.count() == 3 and "comments" not in posts.columns
    rows = comments.collect()
    assert sorted(r.content for r in rows) == ["hello", "there"]
    owner = {r.post_uuid: r.post_id for r in posts.collect()}
    assert {owner[r.post_uuid] for r in rows} == {"p1"}
    assert all(r.comment_id.startswith("p1_") for r in rows)
    by_array = normalize.split_records(df, DAY, guard="array")[1]
    assert sorted(r.content for r in by_array.collect()) == ["hello", "lost", "there"]


def test_keys_hold_over_actions_and_tell_copies_apart(spark):
    df = raw(spark, record("p", [("u", "same text")]), record("p", [("u", "same text")]))
    numbered = df.withColumn("no", F.monotonically_increasing_id())
    first = normalize.split_records(numbered, DAY, ["no"])
    again = normalize.split_records(numbered, DAY, ["no"])
    posts, comments = first[0], again[1]
    assert posts.select("post_uuid").distinct().count() == 2
    # Each copy keeps its own comment: 2 rows, not 4.
    assert comments.join(posts, "post_uuid").count() == 2


def test_sentences(spark):
    df = raw(spark, record("p", [("u", "line one\nline two")]))
    posts, comments = normalize.split_records(df, DAY)
    rows = normalize.sentence_rows(posts, comments).collect()
    assert sorted((r.type, r.sentence) for r in rows) == [
        ("comment", "line one\nline two"), ("post", ""), ("post", "a"), ("post", "b"), ("post", "title p"),
    ]
    assert len({r.sentence_uuid for r in rows}) == 5
    assert all((r.comment_uuid is None) == (r.type == "post") for r in rows)


def test_flatten(spark):
    rows = normalize.flatten_text(raw(spark, record("p", [("u", "x")])), source="youtube").collect()
    assert Counter((r.text, r.view_count, r.source) for r in rows) == Counter(
        [("title p", 3, "youtube"), ("a", 3, "youtube"), ("b", 3, "youtube"), ("", 3, "youtube"), ("x", None, "youtube")]
    )


def test_nesting_in_parts_deals_out_equal_comments_and_loses_nothing(spark):
    posts = spark.createDataFrame([("hot",), ("cold",), ("none",)], "post string")
    sizes = {"hot": 1000, "cold": 7}
    rows = [(p, 5, "same") if p == "hot" and i % 2 else (p, i, f"text {i}") for p, n in sizes.items() for i in range(n)]
    comments = spark.createDataFrame(rows, "post string, pos int, content string")
    nested = normalize.nest_comments(posts, comments, "post", ["pos"], ["pos", "content"], parts=10).collect()
    parts = Counter(r.post for r in nested)
    assert parts["cold"] == parts["none"] == parts["hot"] == 10
    assert {len(r.comments) for r in nested if r.post == "hot"} == {100}
    assert {r.post: r.comment_count for r in nested} == {"hot": 1000, "cold": 7, "none": 0}
    back = [(r.post, c.pos, c.content) for r in nested for c in r.comments]
    assert sorted(back) == sorted(rows)
    assert all([c.pos for c in r.comments] == sorted(c.pos for c in r.comments) for r in nested)
    again = normalize.nest_comments(posts, comments, "post", ["pos"], ["pos", "content"])
    assert again.count() == 3
    assert normalize.count_comments(again).filter("post = 'hot'").first().comment_count == 1000


def test_nested_records_against_plain_python(spark):
    import random

    rng = random.Random(7)
    records = []
    for i in range(60):
        comments = [(rng.choice("uvw"), f"c{rng.randint(0, 9)}") for _ in range(rng.randint(0, 6))]
        records.append(record(f"p{i}", comments, comment_count=rng.choice([0, len(comments)]),
                              like_count=rng.choice([-1, 0, None, 5])))
    good = [r for r in records if r["like_count"] is not None and r["like_count"] >= 0]
    expected = Counter(
        (r["id"], c["comment_nickname"], c["comment_content"], c["comment_like_count"])
        for r in good if r["comment_count"] > 0 for c in r["comments"]
    )
    posts, comments = normalize.split_records(quarantine.good_rows(raw(spark, *records)), DAY)
    joined = comments.join(posts.select("post_uuid", "post_id"), "post_uuid").collect()
    assert Counter((r.post_id, r.author, r.content, r.like_cnt) for r in joined) == expected
    key = stable_key(F.lit(DAY), F.col("post_id"))
    assert posts.filter(F.col("post_uuid") != key).count() == 0
