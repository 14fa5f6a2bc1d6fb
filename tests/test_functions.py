"""Golden rows for the scalar functions."""

from __future__ import annotations

import re
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talkmart.functions import keys, markup, numbers, text, timefn

CLEAN = [
    ("aa..!!", "aa.!"),
    ("a,,b", "ab"),
    ("see http://x y z", "see z"),
    ("HTTPS://A.B c", "c"),
    ("no​break word", "nobreakword"),
    ("@me hi #tag there", "hi there"),
    ('"quoted" [x], y', "quoted x y"),
    ("a  \t b\n c ", "a b c"),
    ("wow~~~ really???", "wow~ really?"),
    ("#", "#"),
    (None, None),
]


def test_clean_golden(values):
    assert values(text.clean, [raw for raw, _ in CLEAN]) == [clean for _, clean in CLEAN]


def test_spelling(values):
    assert values(lambda c: text.clean(c, text.SPELLING), ["투산투산 투산산산"]) == ["투싼투싼 투싼"]


def _plain_clean(s: str) -> str:
    """The cleaning rules in plain Python, for comparison."""
    s = s.lower()
    space = "[ \t\n\x0b\f\r]"
    other = "[^ \t\n\x0b\f\r]"
    for pattern in (f"http{other}+", f"@{other}+", f"#{other}+", r'[",\[\]]+'):
        s = re.sub(pattern, "", s)
    s = re.sub(r"([.!?,~])\1+", r"\1", s)
    s = re.sub("[​-‏‪-‮⁠-⁯﻿ ]", "", s)
    return re.sub(f"{space}+", " ", s).strip(" ")


def test_clean_against_plain_python(values):
    alphabet = st.sampled_from(list('ab가나 .!?,~"[]@# ​\n\t') + ["http://", "https", "..", ",,"])
    texts: list[str] = []

    @settings(max_examples=200, deadline=None, database=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(alphabet, max_size=20).map("".join))
    def gather(s):
        texts.append(s)

    gather()
    assert values(text.clean, texts) == [_plain_clean(s) for s in texts]


def test_length_and_script_filters(spark):
    rows = ["가" + "b" * 9, "가" + "b" * 10, "b" * 20, "한글 http://very.long/url", "short", None]
    df = spark.createDataFrame([(r,) for r in rows], "sentence string")
    assert [r.sentence for r in text.clean_sentences(df).collect()] == ["가" + "b" * 10]


def test_filter_order_differs_between_the_two_cleaners(spark):
    # Long enough only before cleaning; Hangul only inside what is dropped.
    df = spark.createDataFrame([("@한글 plain text here",), ("가나다라마바사아자차카타",)], "text string")
    flat = [r.text for r in text.clean_flat_text(df).collect()]
    strict = [r.text for r in text.clean_sentences(df, "text").collect()]
    assert flat == ["가나다라마바사아자차카타"]
    assert strict == ["plain text here", "가나다라마바사아자차카타"]


def test_parse_count(values):
    assert values(numbers.parse_count, ["1,234", "", "-", None, "7", "x1"]) == [1234, 0, 0, 0, 7, 0]
    assert values(lambda c: numbers.parse_count(c, None), ["1,234", "", None]) == [1234, None, None]


def test_token(values):
    line = "조회 1,234 | 추천 수 5 | 2025.01.30 (목) 11:22"
    assert values(lambda c: numbers.token(c, ("|", 0), (" ", 1)), [line]) == ["1,234"]
    assert values(lambda c: numbers.token(c, ("|", -1), (" ", 2)), [line]) == ["11:22"]
    assert values(lambda c: numbers.token(c, ("|", 7)), [line]) == [None]


def test_dates(values):
    assert timefn.day_bounds("2025-02-01") == (1738335600, 1738421999)
    assert timefn.day_bounds("2025-02-01", zone="+09:00") == timefn.day_bounds("2025-02-01")
    assert timefn.day_bounds("2025-01-31", "2025-02-02") == (1738249200, 1738508399)
    days = values(timefn.to_local_date, [1738335599, 1738335600], "int")
    assert days == [date(2025, 1, 31), date(2025, 2, 1)]
    layouts = (timefn.DOT_LONG, timefn.DOT_SHORT, timefn.DASH)
    epochs = values(
        lambda c: timefn.parse_epoch(c, *layouts),
        ["2025.01.30 11:22", "25.01.30 11:22", "2025.1.3 1:2", "2025-01-30 01:02:03", "zz", None],
    )
    at = lambda *a: int(datetime(*a).timestamp()) - 9 * 3600
    offset = int(datetime(1970, 1, 1).timestamp())
    assert epochs == [
        at(2025, 1, 30, 11, 22) - offset,
        at(2025, 1, 30, 11, 22) - offset,
        at(2025, 1, 3, 1, 2) - offset,
        at(2025, 1, 30, 1, 2, 3) - offset,
        None,
        None,
    ]
    iso = values(lambda c: timefn.parse_epoch(c, timefn.ISO_Z, zone="UTC"), ["2025-01-30T01:02:03Z"])
    assert iso == [1738198923]
    assert values(timefn.parse_short_date, ["25. 01. 30", "25. 13. 30"]) == [date(2025, 1, 30), None]
    assert values(lambda c: timefn.before_marker(c, "/"), ["a b / c", "x"]) == ["a b", "x"]
    assert timefn.shift_day("2025-03-01") == date(2025, 2, 28)
    assert timefn.month_bounds("2024-12-31") == (date(2024, 12, 1), date(2025, 1, 1))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Seoul"])
def test_dates_do_not_depend_on_the_session_zone(spark, values, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert values(timefn.to_local_date, [1738335599, 1738335600], "int") == [date(2025, 1, 31), date(2025, 2, 1)]
        parsed = values(lambda c: timefn.parse_epoch(c, timefn.DASH), ["2025-01-30 01:02:03"])
        assert parsed == [1738198923 - 9 * 3600]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_sql_function(spark):
    timefn.register_sql_functions(spark)
    row = spark.sql("SELECT convert_unix_ts_to_seoul(1738335600) AS t").first()
    assert row.t == datetime(2025, 2, 1)


def test_keys(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a|1:b", "c"), ("a", "1:b|c")], "x string, y string")
    made = df.select(keys.stable_key(F.col("x"), F.col("y")).alias("k"), keys.content_key(F.lit("p"), "x", "y", True).alias("c"))
    rows = made.collect()
    assert len({r.k for r in rows}) == 4
    assert rows[0].c == rows[1].c  # the compatible form skips NULLs


def test_ids_from_links(values):
    assert values(keys.query_id, ["/view?code=x&No=12\n", "none"]) == ["12", "none"]
    assert values(keys.path_id, ["https://h/a/b/99?po=0#c", "https://h/a/7"]) == ["99", "7"]


def test_markup(values):
    html = '<div class="a b">x<div>in &amp; out</div><p> y&nbsp;</p><!-- no --><script>n()</script>z</div><div>after</div>'
    assert values(lambda c: markup.element(c, "div", "b"), [html])[0].endswith("z")
    assert values(lambda c: markup.lines_of(markup.element(c, "div", "b")), [html]) == ["x\nin & out\ny\nz"]
    assert values(lambda c: markup.element(c, "div", "missing"), [html]) == [None]
    assert values(lambda c: markup.attribute(c, "a", "href"), ["<a href='u'>", "<a>", '<a href="">']) == ["u", None, ""]
    assert values(lambda c: markup.links_of(c), ['<a href="1">x</a><a class=q href="2">']) == [["1", "2"]]
    assert values(lambda c: markup.decode_entities(c), ["&lt;&#39;&amp;amp;", None, "a"]) == ["<'&amp;", None, "a"]
