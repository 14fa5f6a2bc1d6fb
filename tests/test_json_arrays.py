"""JSON arrays cut at byte ranges against the reader of whole files."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest

from talkmart import schemas
from talkmart.sources import json_arrays, readers
from tests.test_records import record

ODD = ['plain', 'a } b', '{"x": [1, 2}', 'quote " and \\ back \\" slash }', "}}}{{{][", "tab\t line\n}", "한글 } 문장", "\\}", '"', "", "ends with \\"]


@pytest.fixture
def splits_of(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")

    def put(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield put
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def made(seed, n):
    rng, rows = random.Random(seed), []
    for i in range(n):
        comments = [(rng.choice(ODD), rng.choice(ODD)) for _ in range(rng.randint(0, 3))]
        rows.append(record(f"p{i}", comments, title=rng.choice(ODD), article=rng.choice(ODD) * rng.randint(1, 4)))
    return rows


def counted(df):
    return Counter(map(str, df.collect()))


@pytest.mark.parametrize(("size", "indent", "ascii_"), [(23, None, False), (64, 2, False), (301, None, True), (1 << 20, 1, False)])
def test_same_rows_as_the_reader_of_whole_files(spark, tmp_path, splits_of, size, indent, ascii_):
    for name in "ab":
        rows = made(name, 14)
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, ensure_ascii=ascii_, indent=indent), encoding="utf8")
    want = counted(readers.read_raw_json(spark, str(tmp_path)))
    splits_of(size)
    rows, broken = json_arrays.read_json_arrays(spark, str(tmp_path), schemas.RAW)
    assert counted(rows) == want and sum(want.values()) == 28 and broken.count() == 0
    found = json_arrays.array_records(spark, str(tmp_path / "a.json")).orderBy("block", "no").collect()
    assert [json.loads(r["record"]) for r in found] == made("a", 14)


@pytest.mark.parametrize("size", [17, 1 << 20])
def test_odd_files(spark, tmp_path, splits_of, size):
    whole = json.dumps(made(3, 3), ensure_ascii=False)
    files = {
        "empty": ("", [], 0),
        "no records": ("[ \n ]", [], 0),
        "one object": ('{"id": "x", "title": "}"}', ["x"], 0),
        "lines": ('{"id": "x"}\n{"id": "y"}\n', ["x", "y"], 0),
        "byte order mark": ('﻿[{"id": "x"}]', ["x"], 0),
        "breaks off in a record": (whole[: whole.rindex("}") - 1], ["p0", "p1"], 1),
        "breaks off at a brace": ('[{"id": "x"},\n{"id": "y", "comments": [{"a": 1}', ["x"], 1),
        "not closed": ('[{"id": "x"}, {"id": "y"}', ["x", "y"], 0),
        "ends in line breaks": ('[{"id": "x"}]\n\n', ["x"], 0),
    }
    splits_of(size)
    for name, (text, ids, broken) in files.items():
        path = tmp_path / f"{name.replace(' ', '_')}.json"
        path.write_text(text, encoding="utf8")
        rows, bad = json_arrays.read_json_arrays(spark, str(path), schemas.RAW)
        assert sorted(r.id for r in rows.collect()) == ids and bad.count() == broken, name


def test_values_of_the_wrong_type_become_null(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "x", "like_count": "many", "view_count": 3}]')
    rows, broken = json_arrays.read_json_arrays(spark, str(tmp_path / "a.json"), schemas.RAW)
    assert [(r.id, r.like_count, r.view_count) for r in rows.collect()] == [("x", None, 3)] and broken.count() == 0


def test_a_file_is_read_by_many_tasks(spark, tmp_path, splits_of):
    rows = [{"id": f"p{i}", "article": "x } " * 20} for i in range(400)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    splits_of(4000)
    records = json_arrays.array_records(spark, str(tmp_path / "a.json"))
    assert records.count() == 400 and records.select("block").distinct().count() > 5
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 5
