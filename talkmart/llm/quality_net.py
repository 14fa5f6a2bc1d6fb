"""Quality classifier: random-indexing word vectors, pooled per document, and a small network with calibrated output.

Random indexing: every word has a sparse random index vector; a word's vector is the sum of the index vectors of the
words around all its occurrences in the corpus. Words are hashed to a fixed number of slots, so the vectors are one
table of fixed size, added up over all documents. A document is pooled to the mean and the spread of its words'
vectors. The network has two layers, in numpy; a temperature fitted on labelled rows that did not train it turns its
output into probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmart.llm.staging import stage

#: Slots that words are hashed to, length of the vectors, entries of an index vector that are not 0.
SLOTS, WIDTH, ENTRIES = 1 << 15, 64, 4
#: Numbers that describe a document: mean and spread of its words' vectors, and four more.
INPUTS = 2 * WIDTH + 4
#: Words to each side that count as context.
REACH = 2
#: Parts of the slots that are added up separately.
PARTS = 16
#: Labelled documents for fitting.
LABELLED_ROWS = 20_000
HIDDEN = 32
EPOCHS, BATCH, RATE, DECAY = 60, 128, 3e-3, 1e-4
#: Share of the labelled documents, in eighths, that set the temperature instead of the weights.
CALIBRATION = 2
THRESHOLD = 0.7
#: Words of one batch of numpy work.
_WORDS = 1 << 18
#: Words whose vectors are added up in single precision.
_RUN = 2048

_SPACE = re.compile(r"\s")
# Long texts are cut to words in parts of about so many characters.
_PART_CHARS = 1 << 20


class _Slots(dict):
    """Slot of a word, worked out at its first use; emptied when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        slot = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) % SLOTS
        return slot


def index_places(seed: int = 11) -> np.ndarray:
    """Where each slot's index vector is not 0: it is 1 in the first half of the places and -1 in the second."""
    rng = np.random.default_rng(seed)
    return rng.random((SLOTS, WIDTH), np.float32).argpartition(ENTRIES, axis=1)[:, :ENTRIES].astype(np.int32)


def _words(text: str) -> Iterator[list[str]]:
    """The runs of characters other than white space, in lists of bounded length."""
    start = 0
    while len(text) - start > _PART_CHARS:
        space = _SPACE.search(text, start + _PART_CHARS)
        if not space:
            break
        yield text[start : space.start()].split()
        start = space.end()
    yield (text[start:] if start else text).split()


def _documents(batches: Iterator[pa.RecordBatch], *kept: str) -> Iterator[tuple[np.ndarray, np.ndarray, list[pa.RecordBatch]]]:
    """Slots of all words of some documents in a row, how many each document has, and the documents' kept columns."""
    slots, words, sizes, rows = _Slots(), [], [], []
    held = 0
    for batch in batches:
        start = 0
        for i, text in enumerate(batch["text"]):
            parts = [np.fromiter(map(slots.__getitem__, p), np.int32, len(p)) for p in _words(text.as_py() or "")]
            words += parts
            sizes.append(sum(map(len, parts)))
            held += sizes[-1]
            if held >= _WORDS:
                rows.append(batch.slice(start, i + 1 - start).select(list(kept)))
                yield np.concatenate(words), np.array(sizes, np.int64), rows
                words, sizes, rows, start, held = [], [], [], i + 1, 0
        rows.append(batch.slice(start).select(list(kept)))
    if sizes:
        yield np.concatenate(words), np.array(sizes, np.int64), rows


def _add_contexts(total: np.ndarray, places: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> None:
    """Add to each word's row the index vectors of its neighbours within its document."""
    document = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    rows = words * np.int32(WIDTH)
    for at in range(0, len(words), _WORDS):
        parts = []
        for step in range(1, REACH + 1):
            own, other = slice(at, at + _WORDS), slice(at + step, at + step + _WORDS)
            n = len(words[other])
            left, right = slice(at, at + n), other
            same = document[left] == document[right]
            parts.append((rows[left][same], words[right][same]))
            parts.append((rows[right][same], words[left][same]))
        row, neighbour = (np.concatenate(x) for x in zip(*parts, strict=True))
        codes = row[:, None] + places[neighbour]
        half = ENTRIES // 2
        flat = np.bincount(codes[:, :half].ravel(), minlength=total.size) - np.bincount(codes[:, half:].ravel(), minlength=total.size)
        total += flat.reshape(total.shape)


def _packed(part: int, total: np.ndarray, seen: np.ndarray) -> dict:
    cells = np.hstack([total, seen[:, None]]).astype("<i8")
    return {"part": part, "cells": zlib.compress(cells.tobytes(), 1)}


def _unpacked(cells: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(cells), "<i8").reshape(-1, WIDTH + 1)


_PART = pa.schema([("part", pa.int32()), ("cells", pa.binary())])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, total, seen = index_places(), np.zeros((SLOTS, WIDTH), np.int64), np.zeros(SLOTS, np.int64)
    for words, sizes, _ in _documents(batches):
        _add_contexts(total, places, words, sizes)
        seen += np.bincount(words, minlength=SLOTS)
    step = SLOTS // PARTS
    if seen.any():
        for part in range(PARTS):
            own = slice(part * step, (part + 1) * step)
            yield pa.RecordBatch.from_pylist([_packed(part, total[own], seen[own])], schema=_PART)


def _add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per part of those in this task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, cells in zip(batch["part"].to_pylist(), batch["cells"], strict=True):
            own = _unpacked(cells.as_py())
            sums[part] = sums[part] + own if part in sums else own
    for part, cells in sums.items():
        yield pa.RecordBatch.from_pylist([_packed(part, cells[:, :WIDTH], cells[:, WIDTH])], schema=_PART)


def word_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A vector of length 1 per slot, and each slot's weight in a document: rare words weigh more.

    All documents count. Tasks' sums are added in two steps, each in constant memory; the driver gets PARTS rows of
    fixed size.
    """
    shares = stage(docs.select("text").mapInArrow(_contexts, "part int, cells binary"), "word-contexts")
    groups = max(1, int((shares.count() / PARTS) ** 0.5))
    halfway = shares.repartition(groups).mapInArrow(_add_parts, "part int, cells binary")
    found = halfway.repartition(PARTS, "part").mapInArrow(_add_parts, "part int, cells binary").collect()
    cells = np.zeros((PARTS, SLOTS // PARTS, WIDTH + 1), np.int64)
    for row in found:
        cells[row["part"]] = _unpacked(bytes(row["cells"]))
    cells = cells.reshape(SLOTS, WIDTH + 1)
    total, seen = cells[:, :WIDTH].astype(np.float64), cells[:, WIDTH]
    n = max(int(seen.sum()), 1)
    # What every word's context holds says nothing about a word: the corpus' mean context is taken out.
    off = total - np.outer(seen, total.sum(axis=0) / n)
    vectors = off / np.maximum(np.linalg.norm(off, axis=1, keepdims=True), 1e-9)
    weights = 1e-3 / (1e-3 + seen / n)
    return vectors.astype(np.float32), weights.astype(np.float32)


def pooling_table(vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per slot what a document adds up: weighted vector, weighted squares, weight."""
    weight = weights[:, None]
    return np.hstack([vectors * weight, vectors * vectors * weight, weight])


def pooled(table: np.ndarray, words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row per document: weighted mean and spread of its words' vectors, and what the mean cannot tell.

    That is the share of words that repeat the one before, the share of different words, the length, and a constant.
    """
    out = np.zeros((len(sizes), INPUTS), np.float32)
    out[:, -1] = 1
    end = 0
    for i, size in enumerate(sizes.tolist()):
        own = words[end : end + size]
        end += size
        if not size:
            continue
        total = np.zeros(2 * WIDTH + 1)
        for at in range(0, size, _RUN):
            total += table[own[at : at + _RUN]].sum(axis=0)
        mean, square = total[:WIDTH] / total[-1], total[WIDTH:-1] / total[-1]
        out[i, :WIDTH] = mean
        out[i, WIDTH : 2 * WIDTH] = np.sqrt(np.maximum(square - mean * mean, 0))
        again = np.count_nonzero(own[1:] == own[:-1])
        out[i, -4:-1] = again / size, np.count_nonzero(np.bincount(own)) / size, np.log1p(size) / 8
    return out


@dataclass(frozen=True)
class Network:
    """Two layers and a temperature; inputs are shifted and scaled first."""

    shift: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    second: np.ndarray
    temperature: float = 1.0

    def odds(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.shift) * self.scale @ self.first)
        return np.hstack([hidden, np.ones((len(x), 1))]) @ self.second

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.odds(x) / self.temperature, -30, 30)))


def train_network(x: np.ndarray, y: np.ndarray, seed: int = 5) -> Network:
    """Mini-batch gradient descent with momentum and per-weight step sizes.

    Without both labels the output is the labels' share (a half without any).
    """
    x, y = x.astype(np.float64), y.astype(np.float64)
    inputs = x.shape[1]
    shift, spread = (x.mean(axis=0), x.std(axis=0)) if len(x) else (np.zeros(inputs), np.ones(inputs))
    # A column that hardly varies keeps its scale; the constant column stays 1 for the first layer's bias.
    scale = np.where(spread > 1e-6, 1 / np.maximum(spread, 1e-6), 1.0)
    shift[-1], scale[-1] = 0.0, 1.0
    rng = np.random.default_rng(seed)
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    weights = [rng.standard_normal((inputs, HIDDEN)) / np.sqrt(inputs), np.zeros(HIDDEN + 1)]
    weights[1][-1] = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return Network(shift, scale, weights[0], weights[1])
    z = (x - shift) * scale
    weights[1][:-1] = rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        order = rng.permutation(len(z))
        for at in range(0, len(z), BATCH):
            part = order[at : at + BATCH]
            own = z[part]
            hidden = np.tanh(own @ weights[0])
            full = np.hstack([hidden, np.ones((len(part), 1))])
            slope = (1 / (1 + np.exp(-np.clip(full @ weights[1], -30, 30))) - y[part]) / len(part)
            back = np.outer(slope, weights[1][:-1]) * (1 - hidden**2)
            step += 1
            for i, g in enumerate((own.T @ back + DECAY * weights[0], full.T @ slope + DECAY * weights[1])):
                mean, square = moments[i]
                mean[:] = 0.9 * mean + 0.1 * g
                square[:] = 0.999 * square + 0.001 * g * g
                weights[i] -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Network(shift, scale, *weights)


def calibrated(network: Network, x: np.ndarray, y: np.ndarray) -> Network:
    """The network with the temperature under which ``y`` is likeliest: golden-section search over its logarithm."""
    if not len(y):
        return network
    odds = network.odds(x.astype(np.float64))

    def loss(log_t: float) -> float:
        scaled = odds / np.exp(log_t)
        return float(np.mean(np.logaddexp(0, scaled) - y * scaled))

    low, high, golden = np.log(0.25), np.log(8.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return Network(network.shift, network.scale, network.first, network.second, float(np.exp((low + high) / 2)))


def held_out(doc_id: Column) -> Column:
    """The rows whose labels are never read; False for NULL ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, table: np.ndarray, labelled_rows: int = LABELLED_ROWS) -> Network:
    """The calibrated network from at most ``labelled_rows`` labelled documents that are not held out.

    Of more labelled ids those with the least hashes are used; an id whose rows have different texts, or different
    labels, gives its least text and its largest label.
    """
    seen = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    seen = seen.groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    many = seen.count()
    if many > labelled_rows:  # only those near the limit are sorted
        mark = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
        seen = seen.filter(mark <= int((1 << 20) * min(1.0, 1.2 * labelled_rows / many + 1e-4)))
    seen = stage(seen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows), "quality-labels")
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(seen), "doc_id")
    sample = stage(sample.groupBy("doc_id", "quality").agg(F.min("text").alias("text")), "quality-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, sizes, rows in _documents(batches, "fold", "quality"):
            kept = pa.Table.from_batches(rows)
            own = pooled(table, words, sizes)
            cells = pa.array([r.tobytes() for r in own], pa.binary())
            columns = [kept["fold"].combine_chunks(), kept["quality"].combine_chunks(), cells]
            yield pa.RecordBatch.from_arrays(columns, names=["fold", "quality", "cells"])

    fold = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(8)).cast("int")
    inputs = sample.select(fold.alias("fold"), "quality", "text", F.xxhash64("doc_id").alias("at"))
    rows = inputs.orderBy("at").select("fold", "quality", "text").mapInArrow(run, "fold int, quality int, cells binary").collect()
    x = np.frombuffer(b"".join(bytes(r["cells"]) for r in rows), np.float32).reshape(-1, INPUTS)
    y, folds = np.array([r["quality"] for r in rows]), np.array([r["fold"] for r in rows])
    own = folds >= CALIBRATION
    return calibrated(train_network(x[own], y[own]), x[~own], y[~own])


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, labelled_rows: int = LABELLED_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    ``labels`` has doc_id and quality; NULL ones and those of held-out ids are not read. NULL and empty texts have no
    words and get the score of a document of length 0. Rows with the same text get the same score; repeated rows and
    NULL ids are scored like all others; other columns go. Without labels of both kinds the score is the share of
    label 1 (a half without any). An empty table gives no rows.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    table = pooling_table(*word_vectors(docs))
    network = fit(docs, labels, table, labelled_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, sizes, rows in _documents(batches, "doc_id"):
            score = np.round(network.probability(pooled(table, words, sizes).astype(np.float64)), 6)
            ids = pa.Table.from_batches(rows)["doc_id"].combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.array(score)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
