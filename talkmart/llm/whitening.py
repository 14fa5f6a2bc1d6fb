"""Embedding whitening: the leading eigenvectors of the covariance, by Chebyshev-filtered subspace iteration.

A block of vectors Q, somewhat wider than the number of components, is multiplied by the covariance in distributed
passes: every task centres its rows and adds up its share of X'XQ. A polynomial in the covariance, built by the
Chebyshev recurrence over such passes, is small on the unwanted part of the spectrum and grows steeply above it.
After each filter the block is made orthonormal and turned to its Ritz vectors; this repeats until the residuals
of the wanted pairs are as small as double precision allows.

Where the unwanted spectrum begins is the block's least Ritz value; where it ends is found by Lanczos steps whose
vector rides along as one more column of the first filter's passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmart.llm.staging import stage

#: An entry c counts as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Largest residual of a wanted pair, as a share of the largest eigenvalue.
TOLERANCE = 1e-13
DEGREE = 10
MAX_FILTERS = 40
#: Rows of one stored block; blocks are what a pass reads.
BLOCK_ROWS = 4096
#: Scaled entries are held within these bounds, so that they stay whole numbers of 64 bits.
_BOUND = float(1 << 53)
#: Components whose eigenvalue is a smaller share of the largest count as zero and are left out.
_RANK = 1e-11


@dataclass(frozen=True)
class Moments:
    """Of the fit list: number of rows, their length, and per dimension the sum of the scaled entries before SHIFT."""

    n: int
    width: int
    sums: tuple[int, ...]

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole part and remainder of the mean: centred = (entry - whole) - remainder / n."""
        parts = [divmod(s, self.n) for s in self.sums]
        return np.array([p for p, _ in parts], np.int64), np.array([r for _, r in parts], np.int64)


@dataclass(frozen=True)
class Basis:
    """Unit eigenvectors as columns, largest eigenvalue first, with the trace of the covariance and the error left."""

    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def _blocks(embeddings: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(ids, bits, cells) of the valid rows, stored, and their length.

    A block holds up to BLOCK_ROWS rows: floor(64 c) of all entries as integers of 16, 32 or 64 bits, whichever fits.
    """
    entries = F.col(vector_col).cast("array<double>")
    usable = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    length = F.size(vector_col)
    rows = embeddings.filter(F.col(vector_col).isNotNull() & (length > 0)).filter(usable)
    sizes = rows.groupBy(length.alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = sizes["width"] if sizes else 0
    kind = embeddings.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                cells = np.clip(np.floor(SCALE * part["entries"].flatten().to_numpy()), -_BOUND, _BOUND).astype(np.int64)
                peak = int(np.abs(cells).max(initial=0))
                bits = 16 if peak < 1 << 15 else 32 if peak < 1 << 31 else 64
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part["ids"])
                columns = [ids, pa.array([bits], pa.int32()), pa.array([cells.astype(f"<i{bits // 8}").tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["ids", "bits", "cells"])

    chosen = rows.filter(length == width).select(F.col(id_col).alias("ids"), entries.alias("entries"))
    return stage(chosen.mapInArrow(run, f"ids array<{kind.simpleString()}>, bits int, cells binary"), "whitening-rows"), width


def _cells(batch: pa.RecordBatch, row: int, width: int) -> np.ndarray:
    bits = batch["bits"][row].as_py()
    return np.frombuffer(batch["cells"][row].as_buffer(), f"<i{bits // 8}").astype(np.int64).reshape(-1, width)


def _moments(blocks: DataFrame, width: int) -> Moments:
    """Exact sums: each is added up in two halves that cannot overflow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(width, np.int64), np.zeros(width, np.int64), 0
        for batch in batches:
            for row in range(batch.num_rows):
                cells = _cells(batch, row, width)
                high += (cells >> 32).sum(axis=0)
                low += (cells & 0xFFFFFFFF).sum(axis=0)
                n += len(cells)
        if n:
            columns = [pa.array(np.arange(width + 1)), pa.array(np.append(high, 0)), pa.array(np.append(low, n))]
            yield pa.RecordBatch.from_arrays(columns, names=["dimension", "high", "low"])

    shares = blocks.select("bits", "cells").mapInArrow(run, "dimension long, high long, low long")
    found = {r["dimension"]: (r["high"], r["low"]) for r in shares.groupBy("dimension").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}
    if not found:
        return Moments(0, width, ())
    return Moments(found[width][1], width, tuple((found[i][0] << 32) + found[i][1] for i in range(width)))


def _centred(cells: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (cells - whole).astype(np.float64) - rest


def _pass(blocks: DataFrame, moments: Moments, q: np.ndarray) -> tuple[np.ndarray, float]:
    """Covariance times ``q``, and the covariance's trace: one distributed pass over the centred rows.

    The driver gets one number per entry of the product, whatever the number of rows or tasks.
    """
    whole, rest = moments.centre()
    share, width = rest / moments.n, moments.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares, seen = np.zeros(q.shape), 0.0, False
        for batch in batches:
            for row in range(batch.num_rows):
                x = _centred(_cells(batch, row, width), whole, share)
                total += x.T @ (x @ q)
                squares += float(np.einsum("ij,ij->", x, x))
                seen = True
        if seen:
            values = np.append(total.ravel(), squares)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["cell", "value"])

    parts = blocks.select("bits", "cells").mapInArrow(run, "cell long, value double")
    found = parts.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    values = np.empty(q.size + 1)
    values[found["cell"].to_numpy()] = found["value"].to_numpy()
    return values[:-1].reshape(q.shape) / moments.n, float(values[-1]) / moments.n


class _Lanczos:
    """Lanczos steps from one start vector: a lower bound of the spectrum."""

    def __init__(self, start: np.ndarray) -> None:
        self.basis, self.diagonal, self.off = [start / np.linalg.norm(start)], [], []

    @property
    def column(self) -> np.ndarray:
        return self.basis[-1][:, None]

    def feed(self, image: np.ndarray) -> None:
        """Take the covariance times ``column``."""
        self.diagonal.append(float(self.basis[-1] @ image))
        for _ in range(2):  # twice is enough to stay orthogonal
            for v in self.basis:
                image = image - (v @ image) * v
        size = float(np.linalg.norm(image))
        self.off.append(size)
        # A vanishing rest means that the Krylov space is complete: the last vector is kept and adds nothing.
        self.basis.append(image / size if size > 1e-12 * max(self.diagonal) else np.zeros_like(image))

    def lower(self) -> float:
        if not self.diagonal:
            return 0.0
        k = len(self.diagonal)
        values, vectors = np.linalg.eigh(np.diag(self.diagonal) + np.diag(self.off[: k - 1], 1) + np.diag(self.off[: k - 1], -1))
        return max(0.0, float(values[0] - self.off[-1] * abs(vectors[-1, 0])))


def _ritz(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, largest first, their vectors, and the norm of each pair's residual."""
    image = product(q)
    small = q.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors = q @ turn
    return values, vectors, np.linalg.norm(image @ turn - vectors * values, axis=0)


def _filter(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, degree: int, low: float, high: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of ``degree`` in the covariance times ``q``: damped on [low, high], about 1 at ``top``."""
    centre, half = (high + low) / 2, max((high - low) / 2, 1e-6 * top)
    sigma = half / (top - centre)
    twice = 2 / sigma
    now = (product(q) - centre * q) * (sigma / half)
    for _ in range(2, degree + 1):
        following = 1 / (twice - sigma)
        q, now = now, 2 * (following / half) * (product(now) - centre * now) - sigma * following * q
        sigma = following
    return now


def fit(blocks: DataFrame, moments: Moments, components: int = COMPONENTS, degree: int = DEGREE, seed: int = 7) -> Basis:
    """The leading eigenpairs of the covariance, certified by their residuals.

    Raises ``ArithmeticError`` where they are not reached after MAX_FILTERS filters.
    """
    width = moments.width
    block = min(width, components + max(8, components // 2))
    rng = np.random.default_rng(seed)
    lanczos, trace = _Lanczos(rng.standard_normal(width)), 0.0

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal trace
        out, trace = _pass(blocks, moments, q)
        return out

    def product_and_bound(q: np.ndarray) -> np.ndarray:
        out = product(np.hstack([q, lanczos.column]))
        lanczos.feed(out[:, -1])
        return out[:, :-1]

    q = np.linalg.qr(rng.standard_normal((width, block)))[0]
    wanted = min(components, width)
    for filters in range(MAX_FILTERS + 1):
        values, q, residuals = _ritz(product, q)
        top = float(values[0])
        if top <= 0 or residuals[:wanted].max() <= TOLERANCE * top:
            break
        if filters == MAX_FILTERS:
            raise ArithmeticError(f"residual {residuals[:wanted].max() / top:.1e} of the largest eigenvalue after {filters} filters")
        high = float(values[-1])
        low = min(lanczos.lower(), high)
        q = _filter(product if filters else product_and_bound, q, degree, low, high, top)
        q = np.linalg.qr(q / np.linalg.norm(q, axis=0))[0]
    kept = np.flatnonzero(values[:wanted] > _RANK * top) if top > 0 else np.empty(0, int)
    values, vectors = values[kept], q[:, kept]
    if not len(kept):
        return Basis(vectors, values, trace, 0.0)
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(len(kept))])
    scaled = vectors / np.sqrt(values)
    error = np.abs(scaled.T @ product(scaled) - np.eye(len(kept))).max()
    return Basis(vectors, values, trace, float(error))


def _deviation(cells: np.ndarray, whole: np.ndarray, rest: np.ndarray, n: int) -> list[int | None]:
    """Per row the sum of (n x - S)^2, exact; None where it does not fit 64 bits."""
    reach = np.abs(cells - whole).max(initial=0)
    if cells.shape[1] * (int(reach) * n + n) ** 2 < 1 << 63:
        off = n * (cells - whole) - rest
        return (off * off).sum(axis=1).tolist()
    off = n * (cells - whole).astype(object) - rest.astype(object)
    return [v if v < 1 << 63 else None for v in (off * off).sum(axis=1).tolist()]


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per remaining row and component: ``id_col``, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is NULL or holds a NULL or non-finite entry are dropped. All others are the fit list; it is
    expected to have one length, and rows of another length than most of them (the longer of two equally frequent
    ones) lie in another space and are dropped like invalid ones. Empty vectors have no components. Repeated rows
    and NULL ids count and are returned like all others; further columns go. There are as many components as the
    covariance has eigenvalues above rounding, at most ``components``: none for a table without two different
    vectors, no rows for an empty one. A ``deviation`` beyond 64 bits is NULL. Each component's sign makes its
    entry of largest size positive.
    """
    blocks, width = _blocks(embeddings, id_col, vector_col)
    moments = _moments(blocks, width)
    basis = fit(blocks, moments, components) if moments.n and width else Basis(np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    many = len(basis.values)
    scaled = basis.vectors / np.sqrt(basis.values)
    explained = basis.values / basis.trace if basis.trace else basis.values
    whole, rest = moments.centre() if moments.n else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows if many else 0):
                cells = _cells(batch, row, width)
                projected = _centred(cells, whole, rest / moments.n) @ scaled
                ids, size = batch["ids"].slice(row, 1).flatten(), len(cells)
                deviation = pa.array(_deviation(cells, whole, rest, moments.n), pa.int64())
                each = pa.array(np.repeat(np.arange(size), many))
                columns = [
                    ids.take(each),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * many, moments.n, np.int64)),
                    deviation.take(each),
                    pa.array(projected.ravel()),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * many, basis.identity_error)),
                ]
                names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = embeddings.schema[id_col].dataType.simpleString()
    shape = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return blocks.mapInArrow(run, shape).withColumnRenamed("id", id_col)
