"""Tagging with many aliases, against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from talkmart.operators import aliases, selection
from talkmart.schemas import CAR_ALIASES


def test_same_tags_as_the_expression(spark):
    texts = ["싼타페와 산타페", "그랜저 vs 쏘나타", "none", "", None, "none", "코나 코나 투싼", "코나 코나 투싼"]
    df = spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts)], "text string, digest int")
    table = spark.createDataFrame(list(CAR_ALIASES.items()), "label string, alias string")
    wanted = selection.tag_by_alias(df, "text").collect()
    for most in (1000, 0):
        got = aliases.tag_by_alias_table(df, "text", table, most=most)
        assert got.columns == ["text", "digest", "car_name"] and sorted(got.collect()) == sorted(wanted)


def test_odd_aliases_and_empty_tables(spark):
    df = spark.createDataFrame([("a b",), ("x\U0001f600y",), ("aaa",), ("",)], "text string")
    rows = [("one", "a"), ("two", " a b , "), ("none", None), (None, "a"), ("blank", " "), ("face", "\U0001f600y"), ("one", "a"), ("long", "aaaa")]
    table = spark.createDataFrame(rows, "label string, alias string")
    wanted = [("a b", "one"), ("a b", "two"), ("aaa", "one"), ("x\U0001f600y", "face")]
    for most in (100, 0):
        got = aliases.tag_by_alias_table(df, "text", table, "tag", most=most)
        assert sorted(tuple(r) for r in got.collect()) == wanted
        assert aliases.tag_by_alias_table(df.limit(0), "text", table, most=most).collect() == []
        assert aliases.tag_by_alias_table(df, "text", table.limit(0), most=most).collect() == []
    with pytest.raises(ValueError):
        aliases.tag_by_alias_table(df, "text", table, "text")


def test_a_hundred_thousand_overlapping_aliases(spark):
    deal = random.Random(7)
    draw = lambda n: "".join(deal.choice("abcdefgh가나다라") for _ in range(n))
    names = sorted({draw(deal.choice((5, 6, 7))) for _ in range(104_000)})[:100_000]
    assert len(names) == 100_000
    # Every tenth text is the same one, and some texts are made of aliases that overlap.
    texts = ["".join(deal.sample(names, 2)) if i % 10 else names[0] + names[1] for i in range(200)]
    wide = set(names)
    wanted = {(t, t[i : i + n]) for t in texts for n in (5, 6, 7) for i in range(len(t) - n + 1) if t[i : i + n] in wide}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    table = spark.createDataFrame([(n, n) for n in names], "label string, alias string")
    counts = aliases.pair_counts(df, "text", aliases.clean_aliases(table))
    for given, most in ((counts, 200_000), (counts, 10), (None, 200_000)):
        got = aliases.tag_by_alias_table(df, "text", table, "tag", given, most=most)
        assert {tuple(r) for r in got.collect()} == wanted
        assert got.filter(F.col("tag") == names[0]).count() == sum(names[0] in t for t in texts)


def test_an_alias_is_filed_under_its_rarest_pair(spark):
    names = spark.createDataFrame([("x", "abc"), ("y", "abd"), ("z", "q")], "label string, alias string")
    counts = spark.createDataFrame([("ab", 9), ("bc", 3), ("bd", 12)], "pair string, texts long")
    rows = aliases.alias_index(names, counts).collect()
    assert {(r.alias, r.pair) for r in rows} == {("abc", "bc"), ("abd", "ab"), ("q", "q")}
