"""Toxicity by weak supervision.

Patterns (whole words and beginnings of words) that go with toxic labels are mined from labelled rows and join a
short fixed lexicon. Voters are patterns with a least count. A generative label model says how often each voter
votes on toxic and on clean texts: expectation-maximisation over the counts of all vote combinations in the
corpus, started from the labelled rows, with voters that repeat each other given less weight. A linear
classifier on all pattern counts is then trained on the posterior labels of a bounded sample.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmart.llm.staging import stage

# Words that are insults wherever they stand.
LEXICON = ("clown", "disgusting", "garbage", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
#: Labelled rows that patterns and voters are chosen on, taken by the hash of their ids.
LABELLED_ROWS = 20_000
#: Rows with posterior labels that the classifier is trained on, of each label.
TRAINING_ROWS = 6_000
PATTERNS = 192
VOTERS = 14
LENGTHS = range(3, 9)
THRESHOLD = 0.3
#: Newton steps at most and the strength of the penalty on weights.
STEPS, PENALTY = 40, 1e-4

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never used: crc32 of the id as text leaves 2 modulo 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _patterns(word: str) -> Iterator[str]:
    """What a word can match: itself, written ``=word``, and its beginnings."""
    yield "=" + word
    for n in LENGTHS:
        if n > len(word):
            break
        yield word[:n]


def mine_patterns(labelled: DataFrame, keep: int = PATTERNS) -> list[str]:
    """The patterns that best tell toxic rows of (text, toxic) from others, the lexicon first.

    A pattern's score is the log-likelihood ratio of toxic and clean rows having it, as often as it stands there
    at most three times. ``labelled`` is a bounded sample; its patterns are counted in Spark.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                own = Counter(p for w in _WORD.findall((text.as_py() or "").lower()) for p in _patterns(w))
                for p, n in own.items():
                    for least in range(1, min(n, 3) + 1):
                        sums[toxic.as_py()][(p, least)] += 1
        pairs = sums[0].keys() | sums[1].keys()
        for part in [list(pairs)[i : i + 50_000] for i in range(0, len(pairs), 50_000)]:
            yield pa.RecordBatch.from_pydict(
                {
                    "pattern": [p for p, _ in part],
                    "least": pa.array([n for _, n in part], pa.int32()),
                    "clean": [sums[0][x] for x in part],
                    "toxic": [sums[1][x] for x in part],
                }
            )

    total = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not total.get(1) or not total.get(0):
        return ["=" + w for w in LEXICON]
    counted = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(count, "pattern string, least int, clean long, toxic long")
    sums = counted.groupBy("pattern", "least").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    with_it, without = F.col("toxic") / total[1], F.col("clean") / total[0]
    base = total[1] / (total[0] + total[1])
    n = F.col("toxic") + F.col("clean")
    rate = F.col("toxic") / n
    gain = n * (rate * F.log(F.greatest(rate, F.lit(1e-9)) / base) + (1 - rate) * F.log(F.greatest(1 - rate, F.lit(1e-9)) / (1 - base)))
    best = sums.filter((F.col("toxic") >= 5) & (with_it > without)).groupBy("pattern").agg(F.max(F.round(gain, 6)).alias("gain"))
    rows = best.orderBy(F.desc("gain"), "pattern").limit(8 * keep).collect()
    chosen = ["=" + w for w in LEXICON]
    for row in rows:
        p = row["pattern"]
        # Beginnings of one word have nearly the same rows: one or two of them are enough.
        near = sum(q.lstrip("=").startswith(p.lstrip("=")[:4]) for q in chosen)
        if p not in chosen and near < 6 and len(chosen) < keep:
            chosen.append(p)
    return chosen


def pattern_counts(rows: DataFrame, patterns: list[str]) -> DataFrame:
    """``rows`` with n_words and counts (a number per pattern, at most 65,535) in place of ``text``. Reads whole texts."""
    index = {p: i for i, p in enumerate(patterns)}
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            sizes, counts = [], []
            for text in batch["text"]:
                words = Counter(_WORD.findall((text.as_py() or "").lower()))
                own = np.zeros(len(patterns), np.int64)
                for word, n in words.items():
                    if word not in memory:
                        if len(memory) > 300_000:
                            memory.clear()
                        memory[word] = tuple(index[p] for p in _patterns(word) if p in index)
                    for i in memory[word]:
                        own[i] += n
                sizes.append(sum(words.values()))
                counts.append(np.minimum(own, 65_535).astype("<u2").tobytes())
            columns = [batch[f.name] for f in kept] + [pa.array(sizes, pa.int64()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f.name for f in kept), "n_words", "counts"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(run, f"{shape}, n_words long, counts binary")


def _matrix(counts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(counts), "<u2").reshape(-1, width)


def choose_voters(counts: np.ndarray, toxic: np.ndarray, many: int = VOTERS) -> list[tuple[int, int]]:
    """Pairs (pattern, least count), picked one by one: each adds most toxic rows for the clean rows it adds."""
    options = [(p, n) for p in range(counts.shape[1]) for n in (1, 2, 3)]
    votes = np.stack([counts[:, p] >= n for p, n in options], axis=1) if len(counts) else np.zeros((0, len(options)), bool)
    open_rows, chosen = np.ones(len(counts), bool), []
    while len(chosen) < many and options:
        good = (votes & (open_rows & toxic)[:, None]).sum(axis=0)
        bad = (votes & (~toxic)[:, None]).sum(axis=0)
        points = np.where(good >= 3, good - 3.0 * bad, 0.0)
        best = int(points.argmax()) if len(points) else 0
        if points[best] <= 0:
            break
        chosen.append(options[best])
        open_rows &= ~votes[:, best]
    for p in range(len(LEXICON)):  # the lexicon votes where the labelled rows did not choose
        if len(chosen) < many and all(q != p for q, _ in chosen):
            chosen.append((p, 1))
    return chosen


@dataclass(frozen=True)
class LabelModel:
    """Share of toxic texts, and by voter how often it votes on toxic and on clean texts and how much it counts.

    A voter that keeps quiet says nothing by itself: most are about one language. That all keep quiet is the vote
    of one more voter, for clean, the last in each array.
    """

    share: float
    on_toxic: np.ndarray
    on_clean: np.ndarray
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.log(self.share / (1 - self.share)) + votes @ (self.weight * np.log(self.on_toxic / self.on_clean))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def with_quiet(votes: np.ndarray) -> np.ndarray:
    return np.hstack([votes, ~votes.any(axis=1, keepdims=True)]).astype(np.float64)


def _rates(votes: np.ndarray, n: np.ndarray, weight: float, old: np.ndarray) -> np.ndarray:
    return np.clip((n @ votes + weight * old) / (n.sum() + weight), 1e-4, 1 - 1e-4)


def fit_label_model(votes: np.ndarray, n: np.ndarray, labelled: np.ndarray, toxic: np.ndarray, steps: int = 50) -> LabelModel:
    """Expectation-maximisation over vote combinations (rows of ``votes``), each seen ``n`` times.

    ``labelled`` are the votes on rows with labels; they start the model and stay in it with their number. After each
    step the voters' correlation within a label is worked out from the same table; a voter that goes with others
    counts less, by the root of how many it repeats.
    """
    known = labelled.reshape(-1, votes.shape[1])
    prior = [np.append(np.full(votes.shape[1] - 1, rate), quiet) for rate, quiet in ((0.3, 0.1), (0.01, 0.95))]
    seeds = [_rates(known[rows], np.ones(int(rows.sum())), 2.0, p) for rows, p in zip((toxic, ~toxic), prior, strict=True)]
    share = float(np.clip(toxic.mean() if len(toxic) else 0.05, 0.01, 0.5))
    anchor = max(20.0, float(len(toxic)))
    model = LabelModel(share, *seeds, np.ones(votes.shape[1]))
    for _ in range(steps):
        p = model.posterior(votes)
        sides = (n * p, n * (1 - p))
        parts = (share, 1 - share)
        rates = [_rates(votes, v, anchor * part, old) for v, part, old in zip(sides, parts, seeds, strict=True)]
        extra = np.zeros((votes.shape[1],) * 2)
        for v, rate in zip(sides, rates, strict=True):
            off = votes - rate
            cov = (off * v[:, None]).T @ off / max(v.sum(), 1e-9)
            extra = np.maximum(extra, cov / np.sqrt(np.outer(rate * (1 - rate), rate * (1 - rate))))
        np.fill_diagonal(extra, 0)
        now = float(np.clip((sides[0].sum() + anchor * share) / (n.sum() + anchor), 1e-3, 0.5))
        model = LabelModel(now, *rates, 1 / np.sqrt(1 + np.where(extra > 0.3, extra, 0).sum(axis=1)))
    return model


def _features(counts: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Per pattern how often it stands in a text, in logarithms, and how dense, and the text's length."""
    counts = counts.astype(np.float32)
    words = np.maximum(n_words, 1).astype(np.float32)[:, None]
    return np.hstack([np.log1p(counts), np.log1p(100 * counts / words), np.log1p(words) / 5, np.ones_like(words)])


def _train(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression on soft labels ``y`` with row weights ``n``, by Newton's method."""
    x, n = x.astype(np.float64), n / n.sum()
    scale = 1 / np.maximum(np.sqrt((x**2).mean(axis=0)), 1e-3)
    x = x * scale
    weights, ridge = np.zeros(x.shape[1]), PENALTY * np.eye(x.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (n * (p - y)) + PENALTY * weights
        bend = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        weights -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(slope).max() < 1e-8:
            break
    return weights * scale


def _by_hash(rows: DataFrame, limit: int) -> DataFrame:
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, labelled_rows: int = LABELLED_ROWS, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    ``labels`` has doc_id and toxic; labels of held-out ids and NULL ones are not read. NULL and empty texts get
    the score of a text without any pattern. Without labels of both kinds only the lexicon votes. Repeated rows
    and NULL ids are scored like all others; other columns go. The labelled rows, the training rows and the table
    of vote combinations (at most two to the number of voters) are what reaches the driver.
    """
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    seen = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    seen = _by_hash(seen.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), labelled_rows)
    seen = stage(seen, "toxicity-labels")
    sample = docs.join(F.broadcast(seen), "doc_id")
    patterns = mine_patterns(stage(sample.select("text", "toxic"), "toxicity-sample"))
    counted = stage(pattern_counts(docs, patterns), "toxicity-counts")

    width = len(patterns)
    known = counted.join(F.broadcast(seen), "doc_id").select("counts", "toxic").limit(2 * labelled_rows).collect()
    matrix = _matrix([bytes(r["counts"]) for r in known], width)
    toxic = np.array([r["toxic"] == 1 for r in known], bool)
    voters = choose_voters(matrix, toxic)
    columns, least = np.array([p for p, _ in voters]), np.array([n for _, n in voters])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = 1 << np.arange(len(columns))
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch["counts"].to_pylist(), width)[:, columns] >= least
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(own @ bits)], names=["doc_id", "votes"])

    kind = dict(counted.dtypes)["doc_id"]
    combined = counted.select("doc_id", "counts").mapInArrow(vote, f"doc_id {kind}, votes long")
    table = combined.groupBy("votes").count().collect()
    combos = np.array([[r["votes"] >> i & 1 for i in range(len(voters))] for r in table], bool).reshape(-1, len(voters))
    combos = with_quiet(combos)
    model = fit_label_model(combos, np.array([r["count"] for r in table], np.float64), with_quiet(matrix[:, columns] >= least), toxic)
    posterior = {int(r["votes"]): float(p) for r, p in zip(table, model.posterior(combos), strict=True)}

    mine = counted.filter(~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    rows = []
    for positive in (True, False):
        wanted = [v for v, p in posterior.items() if (p >= 0.5) == positive]
        own = mine.mapInArrow(_with_votes(columns, least, width), f"doc_id {kind}, n_words long, counts binary, votes long")
        rows += _by_hash(own.filter(F.col("votes").isin(wanted)), training_rows).collect() if wanted else []
    x = _features(_matrix([bytes(r["counts"]) for r in rows], width), np.array([r["n_words"] for r in rows]))
    y = np.array([posterior[r["votes"]] for r in rows])
    # The sample has as many rows of either kind as there are up to the limit: weights bring the shares back.
    n_all = {True: 0.0, False: 0.0}
    for r in table:
        n_all[posterior[int(r["votes"])] >= 0.5] += r["count"]
    picked = y >= 0.5
    weight = np.where(picked, n_all[True] / max(picked.sum(), 1), n_all[False] / max((~picked).sum(), 1)) if len(y) else np.ones(0)
    weights = _train(x, y, weight) if len(y) else np.zeros(2 * width + 2)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _features(_matrix(batch["counts"].to_pylist(), width), batch["n_words"].to_numpy(zero_copy_only=False))
                p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.round(p.astype(np.float64), 6))], names=["doc_id", "score"])

    return counted.mapInArrow(score, f"doc_id {kind}, score double").select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def _with_votes(columns: np.ndarray, least: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = 1 << np.arange(len(columns))
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch["counts"].to_pylist(), width)[:, columns] >= least
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_words"], batch["counts"], pa.array(own @ bits)], names=["doc_id", "n_words", "counts", "votes"])

    return run
