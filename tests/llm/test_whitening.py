"""Whitening against a dense eigendecomposition."""

from __future__ import annotations

import numpy as np
import pytest

from talkmart.llm import whitening
from talkmart.llm.whitening import whiten

SHAPE = "vec_id long, embedding array<float>"


def scaled(vectors):
    return np.floor(64 * np.asarray(vectors, np.float32).astype(np.float64)) + 1_000_000


def dense(vectors, components):
    x = scaled(vectors)
    off = x - x.mean(axis=0)
    values, turn = np.linalg.eigh(off.T @ off / len(x))
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    sums = [int(s) for s in x.sum(axis=0)]
    deviation = [sum((len(x) * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return values, off @ turn / np.sqrt(values), deviation, (off**2).sum() / len(x)


def matches(df, vectors, components, rows=None):
    found = df.collect()
    values, want, deviation, trace = dense(vectors, components)
    rows = rows or list(range(len(vectors)))
    assert len(found) == len(vectors) * len(values)
    got = np.full(want.shape, np.nan)
    place = {key: i for i, key in enumerate(rows)}
    for r in found:
        i = place[r["vec_id"]]
        got[i, r["component"] - 1] = r["whitened"]
        assert r["n"] == len(vectors) and r["deviation"] == deviation[i]
        assert abs(r["explained"] - values[r["component"] - 1] / trace) < 1e-12 and r["identity_error"] < 1e-9
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-7


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    matches(whiten(table), [r["embedding"] for r in rows], 32, [r["vec_id"] for r in rows])


def test_steep_and_crowded_spectrum(spark):
    rng = np.random.default_rng(3)
    width = 80
    spread = np.concatenate([np.linspace(40, 30, 10), np.full(6, 20.0), np.linspace(12, 0.5, width - 16)])
    vectors = (rng.standard_normal((600, width)) * spread @ np.linalg.qr(rng.standard_normal((width, width)))[0]).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SHAPE).repartition(5)
    matches(whiten(table, 12), vectors, 12)


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    good = rng.standard_normal((40, 4)).astype(np.float32)
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, nan, 2.0, 3.0]), (103, [1.0, -inf, 0.0, 0.0]), (104, [1.0, 2.0])]
    rows = [(i, v.tolist()) for i, v in enumerate(good)] + odd
    table = spark.createDataFrame([(*r, "x", 9) for r in rows], SHAPE + ", component string, n int")
    matches(whiten(table, 8), good, 4)


def test_repeated_rows_and_ids_without_name(spark):
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (3, [0.0, 5.0]), (3, [2.0, 1.0])]
    out = whiten(spark.createDataFrame(rows, SHAPE)).collect()
    assert len(out) == 8 and sum(r["vec_id"] is None for r in out) == 4
    first = [r["whitened"] for r in out if r["vec_id"] is None and r["component"] == 1]
    assert first[0] == first[1]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [2.0, 3.0])], [(1, [2.0]), (2, [2.0])]])
def test_tables_without_spread_have_no_components(spark, rows):
    assert whiten(spark.createDataFrame(rows, SHAPE)).collect() == []


def test_fewer_dimensions_than_components_in_use(spark):
    rng = np.random.default_rng(5)
    flat = rng.standard_normal((50, 3)) @ rng.standard_normal((3, 3))
    vectors = np.hstack([flat, np.full((50, 2), 7.0)]).astype(np.float32)
    out = whiten(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SHAPE)).collect()
    assert {r["component"] for r in out} == {1, 2, 3} and max(r["identity_error"] for r in out) < 1e-9


def test_large_entries_keep_exact_sums(spark):
    rows = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [1e300, 2.0])]
    out = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in out} == {None} and all(np.isfinite(r["whitened"]) for r in out)


def test_lanczos_bound_lies_below_the_spectrum():
    rng = np.random.default_rng(6)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    values = np.linspace(50, 90, 30)
    matrix = q * values @ q.T
    steps = whitening._Lanczos(rng.standard_normal(30))
    for _ in range(10):
        steps.feed((matrix @ steps.column)[:, 0])
    assert 30 < steps.lower() <= 50 + 1e-9
