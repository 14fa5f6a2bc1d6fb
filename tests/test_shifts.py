"""The Poisson bootstrap against a plain version."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from talkmart.operators import shifts

SCHEMA = "car string, post string, before boolean, score double"


def _rows():
    rng = random.Random(5)
    rows = []
    for post in range(60):
        mood = rng.gauss(0, 0.3)
        for _ in range(rng.randrange(1, 6)):
            rows.append(("a" if post % 2 else None, f"p{post}", post % 3 == 0, round(mood + rng.gauss(0.1, 0.1), 3)))
    rows += [("a", "p1", False, 0.125)] * 500  # a post with most of the rows
    rows += [("a", None, True, -0.5), ("a", "p2", None, 0.5), ("a", "p2", True, None), ("a", "p2", True, float("nan"))]
    return rows + [("one-sided", "p3", True, 0.25)]


def _plain(rows, replicates, tail, seed):
    steps = shifts.poisson_steps()
    posts = defaultdict(lambda: defaultdict(list))
    for car, post, before, score in rows:
        if before is not None and score is not None and not math.isnan(score):
            posts[car][post].append((before, score))

    def weight(post, r):
        digest = hashlib.md5(f"{seed}|{r // 4}|{'-' if post is None else post}".encode()).hexdigest()
        number = int(digest[8 * (r % 4) : 8 * (r % 4) + 7], 16)
        return sum(number >= step for step in steps)

    def shift(own, weights):
        sums = {True: [0, 0.0], False: [0, 0.0]}
        for post, scores in own.items():
            for before, score in scores:
                sums[before][0] += weights[post]
                sums[before][1] += weights[post] * score
        if not (sums[True][0] and sums[False][0]):
            return None
        return sums[False][1] / sums[False][0] - sums[True][1] / sums[True][0]

    out = {}
    for car, own in posts.items():
        found = [shift(own, {p: weight(p, r) for p in own}) for r in range(replicates)]
        found = sorted(s for s in found if s is not None)
        rank = max(1, -(-len(found) * tail // 1000))
        ends = (found[rank - 1], found[-rank]) if found else (None, None)
        out[car] = (shift(own, dict.fromkeys(own, 1)), *ends, len(found))
    return out


@pytest.mark.parametrize("replicates, tail, seed", [(50, 25, 0), (7, 200, 9)])
def test_against_a_plain_version(spark, replicates, tail, seed):
    rows = _rows()
    want = _plain(rows, replicates, tail, seed)
    for parts in (1, 6):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = shifts.shift_intervals(df, ["car"], "post", F.col("before"), "score", replicates, tail, seed).collect()
        assert {r.car for r in got} == set(want) and len(got) == len(want)
        for r in got:
            assert (r.shift, r.low, r.high) == pytest.approx(want[r.car][:3], abs=1e-9)
            assert r.n_replicates == want[r.car][3]
    assert want["one-sided"] == (None, None, None, 0)


def test_weights_are_poisson():
    steps = shifts.poisson_steps()
    chances = [b - a for a, b in zip([0, *steps], [*steps, 1 << shifts.BITS])]
    assert sum(chances) == 1 << shifts.BITS and all(c > 0 for c in chances)
    assert sum(k * c for k, c in enumerate(chances)) / (1 << shifts.BITS) == pytest.approx(1, abs=1e-6)


def test_interval_covers_a_known_shift(spark):
    rng = random.Random(11)
    rows = [(f"c{c}", f"p{c}-{p}", p % 2 == 0, rng.gauss(0 if p % 2 == 0 else 0.3, 0.5)) for c in range(60) for p in range(100)]
    got = shifts.shift_intervals(spark.createDataFrame(rows, SCHEMA), ["car"], "post", F.col("before"), "score").collect()
    assert sum(r.low <= 0.3 <= r.high for r in got) >= 50  # 57 are expected


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert shifts.shift_intervals(df, ["car"], "post", F.col("before"), "score").collect() == []
