"""The quality network: exact context sums, calibration, held-out accuracy, odd rows."""

from __future__ import annotations

import random
import zlib
from dataclasses import replace

import numpy as np
import pyarrow as pa

from talkmart.llm import quality_net as net
from talkmart.llm.quality_net import quality_scores, word_vectors


def plain_contexts(texts):
    places, slots = net.index_places(), net._Slots()
    total, seen = np.zeros((net.SLOTS, net.WIDTH), np.int64), np.zeros(net.SLOTS, np.int64)
    for text in texts:
        words = [slots[w] for w in (text or "").split()]
        for i, w in enumerate(words):
            seen[w] += 1
            for j in range(max(0, i - net.REACH), min(len(words), i + net.REACH + 1)):
                if j != i:
                    half = net.ENTRIES // 2
                    total[w, places[words[j]][:half]] += 1
                    total[w, places[words[j]][half:]] -= 1
    return total, seen


def test_context_sums_against_loops(spark, monkeypatch):
    rng = random.Random(1)
    texts = [None, "", "one", "a b"] + [" ".join(rng.choice("abcdefg") * rng.randint(1, 2) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    shares = docs.select("text").mapInArrow(net._contexts, "part int, cells binary").collect()
    cells = np.zeros((net.PARTS, net.SLOTS // net.PARTS, net.WIDTH + 1), np.int64)
    for r in shares:
        cells[r["part"]] += net._unpacked(bytes(r["cells"]))
    cells = cells.reshape(net.SLOTS, -1)
    total, seen = plain_contexts(texts)
    assert (cells[:, : net.WIDTH] == total).all() and (cells[:, net.WIDTH] == seen).all()
    vectors, weights = word_vectors(docs)
    used = np.flatnonzero(seen)
    off = total - np.outer(seen, total.sum(axis=0) / seen.sum())
    want = off / np.maximum(np.linalg.norm(off, axis=1, keepdims=True), 1e-9)
    assert np.abs(vectors[used] - want[used]).max() < 1e-6 and (weights > 0).all()


def test_words_and_batches_do_not_depend_on_where_texts_are_cut(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["x", "yy", "zzz", "w\n"]) for _ in range(rng.randint(0, 300))) for _ in range(30)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "doc_id": list(range(30))})
    whole = list(net._documents(iter([batch]), "doc_id"))
    assert len(whole) == 1
    monkeypatch.setattr(net, "_PART_CHARS", 17)
    monkeypatch.setattr(net, "_WORDS", 50)
    parts = list(net._documents(iter([batch]), "doc_id"))
    assert len(parts) > 5
    assert (np.concatenate([p[0] for p in parts]) == whole[0][0]).all()
    assert (np.concatenate([p[1] for p in parts]) == whole[0][1]).all()
    assert [i for p in parts for b in p[2] for i in b["doc_id"].to_pylist()] == list(range(30))
    places = net.index_places()
    sums = [np.zeros((net.SLOTS, net.WIDTH), np.int64) for _ in range(2)]
    net._add_contexts(sums[0], places, *whole[0][:2])
    for words, sizes, _ in parts:
        net._add_contexts(sums[1], places, words, sizes)
    assert (sums[0] == sums[1]).all()


def test_pooling_of_a_long_document_is_the_weighted_mean():
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((net.SLOTS, net.WIDTH)).astype(np.float32)
    weights = rng.random(net.SLOTS).astype(np.float32) + 0.1
    words = rng.integers(0, net.SLOTS, 9000).astype(np.int32)
    out = net.pooled(net.pooling_table(vectors, weights), words, np.array([0, 9000, 0]))
    mean = (vectors[words] * weights[words][:, None]).sum(axis=0) / weights[words].sum()
    assert np.abs(out[1, : net.WIDTH] - mean).max() < 1e-4 and not out[0, :-1].any() and not out[2, :-1].any()


def test_network_learns_and_temperature_corrects_it():
    rng = np.random.default_rng(4)
    x = np.hstack([rng.standard_normal((3000, 5)), np.ones((3000, 1))])
    chance = 1 / (1 + np.exp(-2 * np.tanh(x[:, 0] * x[:, 1] * 2)))
    y = (rng.random(3000) < chance).astype(int)
    fitted = net.train_network(x[:1000], y[:1000])
    loss = lambda n: -np.mean(np.log(np.where(y[2000:] == 1, n.probability(x[2000:]), 1 - n.probability(x[2000:]))))
    assert loss(fitted) < 0.6
    sure = replace(fitted, second=6 * fitted.second)
    better = net.calibrated(sure, x[1000:2000], y[1000:2000])
    own = net.calibrated(fitted, x[1000:2000], y[1000:2000])
    assert abs(better.temperature - 6 * own.temperature) < 1e-3 and loss(better) < loss(sure)


def test_held_out_documents_of_the_given_table(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    rows = quality_scores(docs.repartition(4), labels).collect()
    assert len(rows) == docs.count()
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    own = [r for r in rows if r["held_out"] and r["doc_id"] in known]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] for r in rows)
    assert all(r["predicted"] == (r["score"] >= net.THRESHOLD) for r in rows)
    y, score = np.array([known[r["doc_id"]] for r in own]), np.array([r["score"] for r in own])
    order = score.argsort().argsort() + 1
    auc = (order[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.985 and ((score >= net.THRESHOLD) == y).mean() > 0.98
    assert -np.mean(np.log(np.clip(np.where(y == 1, score, 1 - score), 1e-6, 1))) < 0.06


def test_odd_rows_and_labels(spark):
    docs = [(1, "good words here", "x"), (1, "good words here", "y"), (None, "good words here", "z"), (2, None, "x"), (3, "", "x"), (4, "bad bad bad", "x")]
    docs = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (2, None), (3, 1)], "doc_id long, quality int")
    rows = quality_scores(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, None)}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3)}) == 1
    assert quality_scores(docs.limit(0), labels).collect() == []
    assert {r["score"] for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
