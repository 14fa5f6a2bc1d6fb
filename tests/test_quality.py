"""Schema, JSON, key and reference reports."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import types as T

from talkmart import schemas
from talkmart.operators import quality
from tests.test_records import record


def test_schema_differences(spark):
    expected = schemas.CLASSIFIED
    assert quality.schema_differences(expected, expected) == []
    found = T.StructType([f for f in expected.fields if f.name != "keyword"]).add("extra", T.IntegerType())
    assert quality.schema_differences(found, expected) == [("keyword", "string", None), ("extra", None, "int")]
    df = spark.createDataFrame([], found)
    report = quality.schema_report(spark, {"classified": df}, {"classified": expected})
    assert report.count() == 2


def test_json_violations(spark):
    good = record("p", [("u", "x")])
    missing = {k: v for k, v in good.items() if k != "title"}
    deep = record("p", [("u", "x"), ("v", "y")])
    deep["comments"][1]["comment_date"] = "soon"
    del deep["comments"][0]["comment_nickname"]
    cases = [
        (good, []),
        ({**good, "more": {"a": 1}}, []),
        ({**good, "like_count": True}, []),
        ({**good, "like_count": 1.5}, [("root.like_count", "int", "decimal")]),
        ({**good, "like_count": None}, [("root.like_count", "int", "void")]),
        (missing, [("root.title", "str", "missing")]),
        ({**good, "comments": {}}, [("root.comments", "list", "object")]),
        ({**good, "comments": ["x"]}, [("root.comments[0]", "dict", "string")]),
        (deep, [("root.comments[0].comment_nickname", "str", "missing"), ("root.comments[1].comment_date", "int", "string")]),
        ([1], [("root", "dict", "array")]),
    ]
    rows = [(i, json.dumps(doc, ensure_ascii=False)) for i, (doc, _) in enumerate(cases)] + [(99, "not json")]
    found = quality.json_violations(spark.createDataFrame(rows, "i int, json string"), key=["i"]).collect()
    got = {i: sorted((r.path, r.expected, r.found) for r in found if r.i == i) for i, _ in rows}
    assert got.pop(99) == [("root", "dict", "missing")]
    assert got == {i: sorted(expected) for i, (_, expected) in enumerate(cases)}


def test_constraints(spark):
    table = schemas.MART["tb_posts_metric"]
    day = date(2025, 1, 1)
    rows = [("p", "Kona", "clien", 1, 1, 1, 1, day), ("p", "Kona", "x" * 256, None, 1, 1, 1, day), ("q", None, "clien", 1, 1, 1, 1, day)]
    dims = {
        "tb_posts": spark.createDataFrame([("p",)], "post_id string"),
        "tb_car": spark.createDataFrame([("Kona",)], "car_name string"),
        "tb_web_source": spark.createDataFrame([("clien",)], "source string"),
    }
    report = quality.constraint_report(spark.createDataFrame(rows, table.schema), table, dims)
    broken = {r.rule: r.violations for r in report.collect() if r.violations}
    assert broken == {"not null: car_name": 1, "length <= 255: source": 1, "post_id in tb_posts": 1, "source in tb_web_source": 1}
    dim = schemas.MART["tb_web_source"]
    twice = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], dim.schema)
    assert {r.rule: r.violations for r in quality.constraint_report(twice, dim).collect()}["unique: source"] == 1


def test_table_definitions(spark):
    ddl = schemas.MART["tb_car"].ddl()
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS tb_car (car_name string NOT NULL, pre_car_name string, ")
    assert schemas.MART["tb_keywords"].ddl("/x").endswith("PARTITIONED BY (ingestion_date, car_name) LOCATION '/x'")
    assert len(schemas.STAGING) == 4 and len(schemas.MART) == 7
    assert schemas.STAGING["posts"].max_length["post_uuid"] == 36
    assert schemas.MART["tb_posts"].max_length["article"] == 65535
