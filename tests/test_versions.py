"""Versioned tables against plain dictionaries, and what a load writes."""

from __future__ import annotations

import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from talkmart.operators import upsert
from talkmart.session import stored_bytes
from talkmart.sources import versions

SCHEMA = "k string, v string, load_day int"
MERGE = partial(upsert.merge, keys=["k"], update=["v"], order=["load_day"])


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def load(spark, base, schema, rows, small=True, **more):
    source = spark.createDataFrame(rows, schema)
    merger = partial(MERGE, small_source=small)
    return versions.upsert_keyed(source, base, schema, ["k"], merger, small_source=small, buckets=8, **more)


def rows_of(spark, base, schema, version=None):
    return {r["k"]: (r["v"], r["load_day"]) for r in versions.read_keyed(spark, base, schema, ["k"], version).collect()}


@pytest.mark.parametrize("small", [True, False])
def test_random_loads_against_a_dictionary(spark, tmp_path, schema, small):
    base, rng, plain, kept = str(tmp_path / "t"), random.Random(small), {}, {}
    for _ in range(6):
        day, many = rng.randint(1, 9), rng.choice([1, 3, 40])
        rows = [(k, f"{k} on {day} {rng.randint(0, 1)}", day) for k in {f"k{rng.randint(0, 60)}" for _ in range(many)}]
        version = load(spark, base, schema, rows, small)
        for k, v, d in rows:
            if k not in plain or d >= plain[k][1]:
                plain[k] = (v, d)
        kept[version] = dict(plain)
        found = versions.read_keyed(spark, base, schema, ["k"])
        assert found.count() == len(plain) and rows_of(spark, base, schema) == plain
    ids = versions.version_ids(spark, base)
    assert len(ids) == versions.KEPT_VERSIONS
    assert all(rows_of(spark, base, schema, i) == kept[i] for i in ids)


def test_a_small_load_writes_little(spark, tmp_path, schema):
    base = str(tmp_path / "t")
    wide = lambda n, start=0, day=1: spark.range(start, start + n).select(
        F.concat(F.lit("key"), "id").alias("k"), F.sha2(F.concat(F.lit(day), "id").cast("string"), 512).alias("v"), F.lit(day).alias("load_day")
    )
    merger = partial(MERGE, small_source=True)
    versions.upsert_keyed(wide(200_000), base, schema, ["k"], merger, buckets=8)
    full = stored_bytes(spark, f"{base}/data")
    versions.upsert_keyed(wide(2_000, 199_000, 2), base, schema, ["k"], merger, small_source=True)
    assert stored_bytes(spark, f"{base}/data") - full < 0.03 * full
    assert versions.read_keyed(spark, base, schema, ["k"]).agg(F.count("k"), F.sum("load_day")).first() == (201_000, 203_000)
    # The same load again changes nothing and makes no version.
    assert versions.upsert_keyed(wide(2_000, 199_000, 2), base, schema, ["k"], merger, small_source=True) == "0000000002"
    # One key: the other buckets are not read, and their parts are named again.
    before = {p for p in versions.manifest(spark, base)}
    versions.upsert_keyed(wide(1, 5, 3), base, schema, ["k"], merger, small_source=True)
    assert len({p for p in versions.manifest(spark, base)} - before) == 1


def test_units_with_many_changes_are_written_whole(spark, tmp_path, schema):
    base = str(tmp_path / "t")
    load(spark, base, schema, [(f"k{i}", "a", 1) for i in range(80)])
    load(spark, base, schema, [(f"k{i}", "b", 2) for i in range(8)])
    assert any(p.is_change for p in versions.manifest(spark, base))
    load(spark, base, schema, [(f"k{i}", "c", 3) for i in range(70)])
    assert not any(p.is_change for p in versions.manifest(spark, base))
    assert rows_of(spark, base, schema) == {f"k{i}": ("c", 3) if i < 70 else ("a", 1) for i in range(80)}


def test_writers_of_one_version_and_leftovers(spark, tmp_path, schema, monkeypatch):
    base = str(tmp_path / "t")
    load(spark, base, schema, [("a", "1", 1)])
    # Another writer commits between this one's start and end.
    plain = versions._commit

    def late(*args):
        monkeypatch.setattr(versions, "_commit", plain)
        load(spark, base, schema, [("b", "2", 2)])
        plain(*args)

    monkeypatch.setattr(versions, "_commit", late)
    with pytest.raises(Exception, match="exists"):
        load(spark, base, schema, [("c", "3", 3)])
    assert rows_of(spark, base, schema) == {"a": ("1", 1), "b": ("2", 2)}
    # The folder of the writer that came too late was left over and is gone.
    assert len(list((tmp_path / "t" / "data").glob("0000000002-*"))) == 1
    load(spark, base, schema, [("c", "3", 3)])
    assert rows_of(spark, base, schema) == {"a": ("1", 1), "b": ("2", 2), "c": ("3", 3)}


def test_rows_without_a_key_and_empty_loads(spark, tmp_path, schema):
    base = str(tmp_path / "t")
    load(spark, base, schema, [])
    assert rows_of(spark, base, schema) == {} and versions.has_versions(spark, base)
    load(spark, base, schema, [(None, "x", 1), ("a", None, 1)])
    load(spark, base, schema, [(None, "y", 2), ("b", None, None)])
    found = sorted(map(str, versions.read_keyed(spark, base, schema, ["k"]).collect()))
    assert len(found) == 4 and sum("k=None" in r for r in found) == 2


def test_a_first_version_from_rows_that_were_there(spark, tmp_path, schema):
    base = str(tmp_path / "t")
    old = spark.createDataFrame([("a", "old", 1), ("b", "old", 1)], schema)
    load(spark, base, schema, [("b", "new", 2), ("c", "new", 2)], initial=old)
    assert rows_of(spark, base, schema) == {"a": ("old", 1), "b": ("new", 2), "c": ("new", 2)}


def test_replaced_units(spark, tmp_path, schema):
    base, day = str(tmp_path / "t"), F.col("load_day")
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    versions.replace_units(frame(("a", "x", 1), ("b", "x", 2), ("c", "x", 3)), base, day)
    first = versions.version_ids(spark, base)[-1]
    versions.replace_units(frame(("d", "y", 2)), base, day, ["2", "3"])
    read = lambda **kw: sorted(r["k"] for r in versions.read_units(spark, base, schema, **kw).collect())
    assert read() == ["a", "d"] and read(units=["2"]) == ["d"] and read(version=first) == ["a", "b", "c"]
    for _ in range(3):
        versions.replace_units(frame(("e", "z", 9)), base, day)
    # What no kept version names is gone.
    assert read() == ["e"] and len(list((tmp_path / "t" / "data").iterdir())) == 3
