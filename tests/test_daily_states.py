"""States per day against figures worked out from the rows."""

from __future__ import annotations

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from talkmart.operators import daily_states as D
from tests.conftest import plan_of

DAYS = [date(2025, 1, 1) + timedelta(days=i) for i in range(10)]
SPANS = {"before": ("2025-01-01", "2025-01-06"), "after": ("2025-01-05", "2025-01-10"), "none": ("2026-01-01", "2026-01-02")}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = [(rng.choice(DAYS), rng.choice("ab"), f"u{rng.randrange(400)}", round(rng.gauss(0, 0.4), 3)) for _ in range(4000)]
    # One day and car holds a third of all rows; people and scores may be missing.
    made += [(DAYS[0], "a", "u1", 0.25)] * 2000
    return made + [(DAYS[1], "a", None, None), (DAYS[1], "c", None, None), (DAYS[2], None, "u7", float("nan")), (DAYS[2], None, "u7", -1.0)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "ingestion_date date, car string, who string, score double").repartition(5)


def _inside(rows, span):
    first, last = (date.fromisoformat(d) for d in SPANS[span])
    return [r for r in rows if first <= r[0] <= last]


def test_people_of_windows_that_overlap(spark, rows):
    states = D.people_states(_frame(spark, rows), ["car"], "who")
    got = {(r.window, r.car): (r.n_rows, r.n_people) for r in D.people_figures(states, ["car"], SPANS).collect()}
    want = {}
    for span in SPANS:
        for car in {r[1] for r in _inside(rows, span)}:
            own = [r for r in _inside(rows, span) if r[1] == car]
            want[span, car] = (len(own), len({r[2] for r in own} - {None}))
    assert got == want


def test_people_in_both_windows(spark, rows):
    states = D.people_states(_frame(spark, rows), ["car"], "who")
    got = {r.car: r.n_both for r in D.people_in_both(states, ["car"], ("2025-01-01", "2025-01-02"), ("2025-01-09", "2025-01-10")).collect()}
    of = lambda car, days: {r[2] for r in rows if r[1] == car and r[0] in days} - {None}
    assert got == {car: len(of(car, DAYS[:2]) & of(car, DAYS[8:])) for car in "ab"}


def test_many_people_stay_within_the_error(spark):
    people = spark.range(200_000).select(F.lit(DAYS[0]).alias("ingestion_date"), F.lit("a").alias("car"), F.col("id").alias("who"))
    people = people.withColumn("ingestion_date", F.date_add("ingestion_date", (F.col("who") % 10).cast("int")))
    found = D.people_figures(D.people_states(people, ["car"], "who"), ["car"], {"all": ("2025-01-01", "2025-01-10")}).first()
    assert found.n_rows == 200_000
    assert abs(found.n_people / 200_000 - 1) < 4 * 2 ** (-D.LG_PEOPLE / 2)


@pytest.mark.parametrize("width", [0.05, 0.5])
def test_scores_of_windows(spark, rows, width):
    states = D.score_states(_frame(spark, rows), ["car"], "score", width)
    got = D.score_figures(states, ["car"], SPANS, width, (100, 500, 900, 1000)).collect()
    assert {(r.window, r.car) for r in got} == {("before", "a"), ("before", "b"), ("before", None), ("after", "a"), ("after", "b")}
    for r in got:
        own = sorted(x[3] for x in _inside(rows, r.window) if x[1] == r.car and x[3] is not None and not math.isnan(x[3]))
        assert r.n_scored == len(own)
        assert r.mean == pytest.approx(sum(own) / len(own), abs=1e-9)
        for q in (100, 500, 900, 1000):
            exact = own[-(-q * len(own) // 1000) - 1]
            assert abs(r[f"q{q}"] - exact) <= width / 2 + 1e-9


def test_order_of_merging_and_a_replaced_day(spark, rows):
    frame = _frame(spark, rows)
    whole = D.people_states(frame, ["car"], "who")
    by_day = [D.people_states(frame.filter(F.col("ingestion_date") == F.lit(d)), ["car"], "who") for d in (DAYS[4], DAYS[0], DAYS[3])]
    apart = by_day[0].unionByName(by_day[1]).unionByName(by_day[2]).unionByName(whole.filter(~F.col("ingestion_date").isin(DAYS[4], DAYS[0], DAYS[3])))
    key = lambda r: (r.window, str(r.car))
    one, two = (sorted(D.people_figures(s, ["car"], SPANS).collect(), key=key) for s in (whole, apart))
    assert one == two


def test_no_rows(spark, rows):
    empty = _frame(spark, rows).limit(0)
    assert D.people_figures(D.people_states(empty, ["car"], "who"), ["car"], SPANS).collect() == []
    assert D.score_figures(D.score_states(empty, ["car"], "score", 0.1), ["car"], SPANS, 0.1).collect() == []


def test_window_bounds_reach_the_scan(spark, rows, tmp_path):
    D.score_states(_frame(spark, rows), ["car"], "score", 0.1).write.parquet(str(tmp_path / "states"))
    figures = D.score_figures(spark.read.parquet(str(tmp_path / "states")), ["car"], SPANS, 0.1)
    assert "GreaterThanOrEqual(ingestion_date,2025-01-01)" in plan_of(figures)
