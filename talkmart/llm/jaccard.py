"""N-gram Jaccard join: documents whose sets of five-word shingles are at least 0.8 alike.

Multiple global orders: the tokens (64-bit hashes of shingles) of every set are put into several total orders
that are the same for all sets. Two sets that are alike enough share a token among the first n - ceil(0.8 n) + 1
of each order. The first order puts tokens that are frequent in the corpus last, and after them those that crowd the
prefixes, ties by hash; its prefixes make the candidates, cut by length and position. The other two orders are ascending and descending by hash; a
candidate must share prefix tokens there too before its sets are compared as a whole.

Groups of copies never become all their pairs. Texts with equal words are one class from the start. Then each
prefix token offers its classes one leader, another for each token, and a class is compared with the nearest few of
those it meets most often; classes found alike become one component, and only tokens that still join different components are looked at again,
with every pair across components. So each pair of classes that shares a prefix token either lies in one component,
was compared or is too far apart by its marks.

A mark has a bit per slot of the hash range: whether an odd number of a set's tokens fall there. Two marks differ in
as many bits as the sets have tokens that are not common, or fewer, so marks that differ more rule a pair out and
lose none. A class has a mark that grows with its set. Postings carry none, only those of tokens that join different
components are given one of 512 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmart.llm.components import components
from talkmart.llm.staging import arrow_batches, small, stage
from talkmart.llm.text import free_name, row_key

WIDTH = 5
#: Similarity in per cent.
PERCENT = 80
#: Counters of the frequency sketch. Its size does not grow with the corpus; it only shapes the first order.
CELLS = 1 << 20
#: Bits of the filters that pick out shared tokens and candidates' texts. More of these than bits only make the
#: filters pass more. Primes, so that numbers with a stride do not meet.
TOKEN_BITS, FILTER_BITS = 33_554_393, 4_194_301
#: Times that a token stands in the prefixes of several classes from which it counts as crowded and comes last.
CROWD = 12
#: Leaders that a class is compared with before the pairs across components, and those whose marks are looked at for it.
LEADERS, OFFERS = 3, 6
#: Bits of a posting's mark, and of the largest mark of a class (both powers of two).
MARK_BITS, MOST_BITS = 512, 32_768

#: Rows of a batch that a Python task gets at once.
BATCH_ROWS = 1000
#: Tokens that a task holds in lists before it counts them or hands them on.
_HELD = 1 << 19
#: Bytes of text whose words are cut together.
_CUT_BYTES = 1 << 20

_MULTIPLIER, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SIGNATURES = "doc_id long, row_key string, class long, n long, cells binary"
_MARKS = [f"mark_{i}" for i in range(MARK_BITS // 64)]
_TOKENS = "class long, n int, tokens array<long>"
_PREFIXES = f"{_TOKENS}, bits binary"
_POSTINGS = "token long, class long, n int, place int"
_OWN = ("class", "n", "place")
_SETS = "class long, n int, grams array<long>"


def _windows(values: np.ndarray, width: int) -> np.ndarray:
    """A token for each ``width`` neighbouring word hashes."""
    mixed = np.full(max(len(values) - width + 1, 0), width, np.uint64)
    for i in range(width if len(mixed) else 0):
        mixed *= _MULTIPLIER
        mixed += values[i : len(mixed) + i]
        mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    return mixed ^ (mixed >> np.uint64(32))


def _digests(strings: pa.Array) -> np.ndarray:
    values = strings.cast(pa.binary()).to_numpy(zero_copy_only=False)
    return np.fromiter(map(xxhash.xxh64_intdigest, values), np.uint64, len(values))


class _Cut:
    """Some texts whose words were cut and hashed together: the class of each and, where wanted, its tokens."""

    def __init__(self, texts: pa.Array):
        # Arrow cuts at exactly the six ASCII white-space characters, with empty words at the ends of a text.
        lists = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(pa.compute.fill_null(texts, "")))
        words, offsets = lists.flatten(), lists.offsets.to_numpy()
        filled = pa.compute.not_equal(words, "")
        before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])
        self._ends, words = before[offsets - offsets[0]], words.filter(filled)
        coded = words.dictionary_encode()
        self._hashes = _digests(coded.dictionary)[coded.indices.to_numpy()]
        self._tokens = _windows(self._hashes, WIDTH)
        joined = pa.compute.binary_join(pa.ListArray.from_arrays(pa.array(self._ends, pa.int32()), words), " ")
        self.classes = _digests(joined).tolist()

    def grams(self, row: int) -> np.ndarray:
        """Distinct tokens of a text in ascending order."""
        start, end = self._ends[row], self._ends[row + 1]
        if end - start < WIDTH:
            return _windows(self._hashes[start:end], int(end - start)) if end > start else np.empty(0, np.uint64)
        tokens = np.sort(self._tokens[start : end - WIDTH + 1])
        return tokens[np.concatenate(([True], tokens[1:] != tokens[:-1]))]


def _cuts(texts: pa.Array) -> Iterator[_Cut]:
    """A batch's texts in runs of some million characters, or one text that is longer."""
    sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    run = (np.cumsum(sizes.astype(np.int64)) - sizes) // _CUT_BYTES
    starts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    for start, end in zip(starts, starts[1:]):
        if end > start:
            yield _Cut(texts.slice(start, end - start))


def _cell(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64(CELLS - 1)).astype(np.int64)


def _signed(values) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


def _prefix_size(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and at the end of the task one with its counts per cell of the sketch."""
    cells, held = np.zeros(CELLS, np.uint32), []

    def count() -> None:
        if held:
            cells[:] += np.bincount(np.concatenate(held), minlength=CELLS).astype(np.uint32)
            held.clear()

    waiting = 0
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row_key", pa.string()), ("class", pa.int64()), ("n", pa.int64()), ("cells", pa.binary())]
    )
    for batch in batches:
        classes, sizes, seen = [], [], {}
        for cut in _cuts(batch["text"]):
            for row, name in enumerate(cut.classes):
                if name not in seen:  # copies in a batch count once
                    grams = cut.grams(row)
                    seen[name] = len(grams)
                    held.append(_cell(grams).astype(np.int32))
                    waiting += len(grams)
                    if waiting > _HELD:
                        count()
                        waiting = 0
                classes.append(name)
                sizes.append(seen[name])
        count()
        own = [pa.array(_signed(classes)), pa.array(sizes, pa.int64()), pa.nulls(len(sizes), pa.binary())]
        columns = [batch["doc_id"], batch["row_key"].cast(pa.string()), *own]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)
    if cells.any():
        yield pa.RecordBatch.from_pylist([{"n": -1, "cells": cells.tobytes()}], schema=schema)


def _add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS, np.uint64)
    for batch in batches:
        for cells in batch["cells"]:
            total += np.frombuffer(cells.as_py(), np.uint64 if len(cells.as_py()) == 8 * CELLS else np.uint32)
    if total.any():
        yield pa.RecordBatch.from_pydict({"cells": pa.array([total.tobytes()], pa.binary())})


def _levels(signatures: DataFrame) -> np.ndarray:
    """A level per cell: 0 for usual counts, then one more with each doubling of what lies above them.

    The tasks' counts are added in two steps, each in constant memory; the driver gets one row of fixed size.
    """
    cells = signatures.filter("n < 0").select("cells")
    groups = max(1, int(cells.count() ** 0.5))
    cells = cells.repartition(groups).mapInArrow(_add_cells, "cells binary")
    found = cells.repartition(1).mapInArrow(_add_cells, "cells binary").collect()
    if not found:
        return np.zeros(CELLS, np.uint8)
    counts = np.frombuffer(found[0]["cells"], np.uint64).astype(np.float64)
    usual = np.median(counts)
    above = np.maximum(counts - usual, 0) / (6 * np.sqrt(usual) + 16)
    return np.floor(np.log2(1 + above)).astype(np.uint8)


def _mark(grams: np.ndarray) -> bytes:
    """A bit per slot: whether it has an odd number of the tokens. Two to four slots for each token, within the bounds."""
    size = min(MOST_BITS, max(MARK_BITS, 1 << (2 * len(grams) - 1).bit_length()))
    slots = (grams >> np.uint64(24)) & np.uint64(size - 1)
    odd = np.bincount(slots.astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(mark: bytes, size: int) -> np.ndarray:
    """The mark of the same set with ``size`` bytes, a power of two up to its own size."""
    return np.bitwise_xor.reduce(np.frombuffer(mark, np.uint64).reshape(-1, size // 8), axis=0)


def _prefixes(levels: np.ndarray, crowded: np.ndarray | None = None, only: np.ndarray | None = None):
    """Each class with its prefix under the first order; copies within a batch once.

    ``crowded`` tokens come after all others; then the marks are left out. With ``only``, just the documents whose ids
    pass that filter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, classes, sizes, marks = [], [], [], [] if crowded is None else None
            for name, grams in _distinct(batch, only):
                rank = levels[_cell(grams)]
                if crowded is not None:
                    rank = rank + (_passes(crowded, grams.view(np.int64), TOKEN_BITS) << 7)
                order = np.argsort(rank, kind="stable")[: _prefix_size(len(grams))]
                tokens.append(grams[order])
                classes.append(name)
                sizes.append(len(grams))
                if marks is not None:
                    marks.append(_mark(grams))
                if _full(tokens):
                    yield _listed(classes, sizes, tokens, "tokens", marks)
            if tokens:
                yield _listed(classes, sizes, tokens, "tokens", marks)

    return run


def _full(arrays: list[np.ndarray]) -> bool:
    return len(arrays) % 64 == 0 and sum(map(len, arrays)) > _HELD


def _listed(
    classes: list[int], sizes: list[int], arrays: list[np.ndarray], name: str, marks: list[bytes] | None = None
) -> pa.RecordBatch:
    """A batch of what the lists hold; they are empty afterwards."""
    columns = {"class": pa.array(_signed(classes)), "n": pa.array(sizes, pa.int32()), name: _lists(arrays)}
    if marks is not None:
        columns["bits"] = pa.array(marks, pa.binary())
    batch = pa.RecordBatch.from_pydict(columns)
    for done in (classes, sizes, arrays, marks or []):
        done.clear()
    return batch


def _distinct(batch: pa.RecordBatch, only: np.ndarray | None) -> Iterator[tuple[int, np.ndarray]]:
    """The classes of a batch that have words, each once, with their tokens.

    With ``only``, just those of rows whose doc_id passes that filter; a NULL counts as -1.
    """
    if only is not None:
        ids = batch["doc_id"].fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        batch = batch.filter(pa.array(_passes(only, ids, FILTER_BITS) == 1))
    seen = set()
    for cut in _cuts(batch["text"]):
        for row, name in enumerate(cut.classes):
            if name not in seen:
                seen.add(name)
                grams = cut.grams(row)
                if len(grams):
                    yield name, grams


def _held(batch: pa.RecordBatch, crowded: np.ndarray) -> np.ndarray:
    """Whether each prefix of a batch holds crowded tokens; no prefix is empty."""
    sizes = pa.compute.list_value_length(batch["tokens"]).to_numpy()
    hits = _passes(crowded, batch["tokens"].flatten().to_numpy(), TOKEN_BITS)
    return np.add.reduceat(hits, np.cumsum(sizes) - sizes, dtype=np.int64) > 0 if len(sizes) else np.empty(0, bool)


def _holding(crowded: np.ndarray, wanted: bool):
    """The prefixes that hold crowded tokens, or those that do not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_held(batch, crowded) == wanted))

    return run


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(_signed(np.concatenate(arrays))))


def _postings(bits: np.ndarray, crowded: np.ndarray | None = None):
    """A row per prefix token that passes the filter of shared tokens, with its place in the prefix.

    Prefixes that hold ``crowded`` tokens are left out here, not by a task before: that would be another Python worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if crowded is not None:
                batch = batch.filter(pa.array(~_held(batch, crowded)))
            lists = batch["tokens"]
            tokens, sizes = lists.flatten().to_numpy(), pa.compute.list_value_length(lists).to_numpy()
            row = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = np.flatnonzero(_passes(bits, tokens, TOKEN_BITS))
            columns = [tokens[kept], batch["class"].to_numpy()[row[kept]], batch["n"].to_numpy()[row[kept]], place[kept].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", *_OWN])

    return run


def _short_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mark of each class, folded to ``MARK_BITS``."""
    for batch in batches:
        marks = np.array([_folded(mark, MARK_BITS // 8) for mark in batch["bits"].to_pylist()], np.uint64).reshape(-1, len(_MARKS))
        columns = [batch["class"], *(pa.array(np.ascontiguousarray(c)) for c in marks.view(np.int64).T)]
        yield pa.RecordBatch.from_arrays(columns, names=["class", *_MARKS])


def _bits(values: DataFrame, size: int) -> np.ndarray:
    """Which remainders modulo ``size`` a column ``value`` takes: ``size`` bits to the driver, however many rows."""
    slot = values.select(F.pmod(F.coalesce("value", F.lit(-1)), F.lit(size)).alias("slot"))
    words = slot.groupBy((F.col("slot") / 64).cast("int").alias("word"))
    packed = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")).toArrow()
    table = np.zeros(size // 64 + 1, np.int64)
    table[packed["word"].to_numpy()] = packed["bits"].to_numpy()
    return table.view(np.uint8)


def _passes(bits: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """0 or 1 for each value: whether its remainder is in the filter, which stays packed."""
    slot = values % size
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1


def _sets(bits: np.ndarray):
    """The whole sets of the documents whose ids pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, sizes, grams = [], [], []
            for name, own in _distinct(batch, bits):
                classes.append(name)
                grams.append(own)
                sizes.append(len(own))
                if _full(grams):
                    yield _listed(classes, sizes, grams, "grams")
            if grams:
                yield _listed(classes, sizes, grams, "grams")

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _alike(overlap, n, m):
    """100 * intersection >= PERCENT * union."""
    return (100 + PERCENT) * overlap >= PERCENT * (n + m)


def _lengths_fit() -> Column:
    return 100 * F.least("n", "other_n") >= PERCENT * F.greatest("n", "other_n")


def _may_be_alike() -> Column:
    """Length bound, and the position bound: what can still be shared from this token on."""
    left, right = F.col("n") - F.col("place"), F.col("other_n") - F.col("other_place")
    return _lengths_fit() & _alike(F.least(left, right), F.col("n"), F.col("other_n"))


def _marks_differ() -> Column:
    """In how many bits the marks of two postings differ: at most as many as there are tokens in one of the sets only."""
    bits = [F.bit_count(F.col(m).bitwiseXOR(F.col(f"other_{m}"))) for m in _MARKS]
    return sum(bits[1:], bits[0])


def _near_enough(differ, n, m):
    """Whether sets of n and m tokens, ``differ`` of them or more in one set only, may still be alike."""
    return (100 + PERCENT) * differ <= (100 - PERCENT) * (n + m)


def _marks_fit() -> Column:
    return _near_enough(_marks_differ(), F.col("n"), F.col("other_n"))


def _ends() -> tuple[Column, Column]:
    return F.least("class", "other_class").alias("low"), F.greatest("class", "other_class").alias("high")


def _led(postings: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs of classes (low, high) with a prefix token in common, ``a`` the one that leads.

    Each token offers one of its classes as leader, every token by an order of its own, so that a class of a crowd
    meets as many of the others as it has tokens. Of the ``OFFERS`` that it meets most often it takes the ``LEADERS``
    whose marks are nearest to its own.
    """
    order = F.struct(F.xxhash64("class", "token").alias("rank"), *_OWN)
    leads = postings.groupBy("token").agg(F.min(order).alias("lead"))
    leads = leads.select("token", *(F.col(f"lead.{c}").alias(f"other_{c}") for c in _OWN))
    offers = postings.join(leads, "token").filter((F.col("class") != F.col("other_class")) & _may_be_alike())
    met = offers.groupBy("class", "other_class").agg(F.count(F.lit(1)).alias("times"))
    most = F.slice(F.sort_array(F.collect_list(F.struct("times", "other_class")), asc=False), 1, OFFERS)
    most = met.groupBy("class").agg(most.alias("most")).select(F.col("class").alias("low"), F.explode("most.other_class").alias("high"))
    near = _marked_near(most.withColumn("a", F.col("high")), marks)
    nearest = near.groupBy(F.col("low").alias("class")).agg(
        F.slice(F.sort_array(F.collect_list(F.struct("differ", "a"))), 1, LEADERS).alias("offers")
    )
    pairs = nearest.select("class", F.explode("offers.a").alias("other_class"))
    return pairs.groupBy(*_ends()).agg(F.min("other_class").alias("a"))


def _across(postings: DataFrame, marks: DataFrame) -> DataFrame:
    """All pairs of classes (low, high) across components that share a prefix token and whose marks are near enough.

    The classes outside a token's main component meet everyone. A component's number is its least class, so the
    least one of a token is most likely the largest. Tokens within one component are left out.
    """
    tokens = postings.groupBy("token").agg(F.min("component").alias("main"), F.max("component").alias("high"))
    mixed = postings.join(tokens.filter("main <> high").select("token", "main"), "token")
    short = marks.select("class", "bits").mapInArrow(_short_marks, "class long, " + ", ".join(f"{m} long" for m in _MARKS))
    mixed = stage(mixed.join(short, "class"), "mixed")
    mixed = mixed.withColumn("is_main", F.col("component") == F.col("main")).drop("main")
    others = mixed.select("token", *(F.col(c).alias(f"other_{c}") for c in (*_OWN, *_MARKS, "component", "is_main")))
    once = F.col("other_is_main") | (F.col("class") < F.col("other_class"))
    apart = F.col("component") != F.col("other_component")
    rows = mixed.filter(~F.col("is_main")).join(others, "token").filter(apart & once & _may_be_alike() & _marks_fit())
    low, high = _ends()
    return rows.select(low, high).distinct().withColumn("a", F.col("low"))


def _compare_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose marks, folded to the smaller of their sizes, are near enough, and in how many bits they differ."""
    for batch in batches:
        kept, bits = [], []
        for low, high, n, m in zip(*(batch[c].to_pylist() for c in ("low_bits", "high_bits", "low_n", "high_n")), strict=True):
            size = min(len(low), len(high))
            differ = int(np.bitwise_count(_folded(low, size) ^ _folded(high, size)).sum())
            kept.append(_near_enough(differ, n, m))
            bits.append(differ)
        columns = [*(batch[c] for c in ("low", "high", "a")), pa.array(bits, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["low", "high", "a", "differ"]).filter(pa.array(kept, pa.bool_()))


def _marked_near(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs that the marks of their classes leave."""
    side = lambda end: marks.select(F.col("class").alias(end), F.col("n").alias(f"{end}_n"), F.col("bits").alias(f"{end}_bits"))
    both = pairs.join(side("low"), "low").join(side("high"), "high")
    columns = ("low", "high", "a", "low_n", "high_n", "low_bits", "high_bits")
    return both.select(*columns).mapInArrow(_compare_marks, "low long, high long, a long, differ int")


def _passing(bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_passes(bits, batch["class"].to_numpy(), FILTER_BITS) == 1))

    return run


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough, compared as a whole.

    Sets that no pair of the round names are filtered out before they are shuffled. Many pairs have few leaders, so
    the members' sets move to their leaders'.
    """
    pairs = pairs.select("a", F.when(F.col("a") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("b"))
    prefix = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1

    def side(name: str) -> DataFrame:
        named = sets.mapInArrow(_passing(_bits(pairs.select(F.col(name).alias("value")), FILTER_BITS)), _SETS)
        return named.select(
            F.col("class").alias(name),
            F.col("n").alias(f"{name}_n"),
            F.col("grams").alias(f"{name}_grams"),
            prefix.cast("int").alias(f"{name}_size"),
        )

    # Ascending and descending order of a set sorted by hash: its first and its last tokens.
    first = lambda s: F.slice(f"{s}_grams", F.lit(1), F.col(f"{s}_size"))
    last = lambda s: F.slice(f"{s}_grams", F.col(f"{s}_n") - F.col(f"{s}_size") + 1, F.col(f"{s}_size"))
    shared = F.arrays_overlap(first("a"), first("b")) & F.arrays_overlap(last("a"), last("b"))
    overlap = F.when(shared, F.size(F.array_intersect("a_grams", "b_grams"))).otherwise(0)
    both = side("b").join(small(pairs), "b").join(side("a"), "a")
    return both.filter(_alike(overlap, F.col("a_n"), F.col("b_n"))).select("a", "b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, row_key, n_shingles, component_id, group.

    ``component_id`` is the smallest id among all documents reachable by links, ``group`` a number for the same
    documents. Documents without words have no shingles, no group and their own id. Repeated rows and several texts
    under one id are kept; NULL ids join groups but do not name them (a group of NULL ids only has component NULL).
    Other columns go.

    A class is a 64-bit hash of a text's words. Staged tables hold ids, hashes and candidates' sets, no texts.
    """
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        return _near_duplicates(docs)


def _added_sets(texts: DataFrame, pairs: DataFrame, ids: DataFrame, sets: DataFrame | None) -> DataFrame:
    """The whole sets of the pairs' classes that ``sets`` does not have yet.

    A few more pass the filter by chance, or again for a repeated row: they meet no pair, or give a link twice.
    """
    members = pairs.select(F.col("low").alias("class")).union(pairs.select("high")).distinct()
    if sets is not None:
        members = members.join(sets.select("class"), "class", "left_anti")
    wanted = _bits(members.join(ids, "class").select(F.col("doc_id").alias("value")), FILTER_BITS)
    return stage(texts.mapInArrow(_sets(wanted), _SETS), "sets")


def _placed(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("class"), "component")


def _near_duplicates(docs: DataFrame) -> DataFrame:
    texts = _texts(docs)
    keys = texts.withColumn("row_key", row_key())
    signatures = stage(keys.mapInArrow(_signatures, _SIGNATURES), "signatures")
    levels = _levels(signatures)
    rows = signatures.filter("n >= 0").select("doc_id", "row_key", "class", "n")
    ids = rows.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("doc_id"))

    # The sketch does not tell a token of some dozen classes from a rare one. Prefixes that hold such tokens are taken
    # again with these last; the others hold none, so they are the same under both orders.
    prefixes = stage(texts.mapInArrow(_prefixes(levels), _PREFIXES), "prefixes")
    by_token = prefixes.select("class", F.explode("tokens").alias("value")).groupBy("value")
    counts = by_token.agg(F.count(F.lit(1)).alias("times"), F.min("class").alias("low"), F.max("class").alias("high"))
    crowded = _bits(counts.filter((F.col("times") >= CROWD) & (F.col("low") != F.col("high"))).select("value"), TOKEN_BITS)
    marks = stage(prefixes.select("class", "n", "bits").dropDuplicates(["class"]), "marks")
    prefixes = prefixes.select("class", "n", "tokens")
    held = prefixes.mapInArrow(_holding(crowded, True), _TOKENS).select("class").distinct().join(ids, "class")
    again = texts.mapInArrow(_prefixes(levels, crowded, _bits(held.select(F.col("doc_id").alias("value")), FILTER_BITS)), _TOKENS)
    again = stage(again, "prefixes")
    tokens = prefixes.mapInArrow(_holding(crowded, False), _TOKENS).unionByName(again)
    tokens = tokens.select("class", F.explode("tokens").alias("value")).groupBy("value")
    shared = tokens.agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high")
    bits = _bits(shared.select("value"), TOKEN_BITS)
    postings = prefixes.mapInArrow(_postings(bits, crowded), _POSTINGS).unionByName(again.mapInArrow(_postings(bits), _POSTINGS))
    postings = stage(postings.distinct(), "postings")

    pairs = stage(_led(postings, marks), "pairs")
    sets = _added_sets(texts, pairs, ids, None)
    links = stage(_verified(pairs, sets), "links")
    known = stage(_placed(links), "components")  # (class, component) of the classes that have links
    joined = small(known).withColumnRenamed("component", "joined")
    placed = postings.join(joined, "class", "left").withColumn("component", F.coalesce("joined", "class")).drop("joined")
    # What was compared before and not found alike is not compared again.
    left = _across(placed, marks).join(pairs.select("low", "high"), ["low", "high"], "left_anti")
    left = stage(_marked_near(left, marks).drop("differ"), "pairs")
    if not left.isEmpty():
        sets = sets.unionByName(_added_sets(texts, left, ids, sets))
        found = _verified(left, sets)
        # Classes of one component are linked through its least class: their own links need not be looked at again.
        known = _placed(found.unionByName(known.select(F.col("class").alias("a"), F.col("component").alias("b"))))

    ids = ids.withColumn("group", F.col("class"))
    ids = ids.join(known, "class", "left").withColumn("group", F.coalesce("component", "class")).drop("component")
    least = ids.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    ids = ids.select(F.col("class").alias("id_class"), "group").join(least, "group")
    has_words = F.col("n") > 0
    return rows.join(ids, has_words & (F.col("class") == F.col("id_class")), "left").select(
        "doc_id",
        "row_key",
        F.col("n").alias("n_shingles"),
        F.when(has_words, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "group",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document left of each group, the one with the smallest id.

    Of a document's repeated rows one stays. Documents without words all stay. All columns are kept.
    """
    marked = stage(near_duplicates(docs), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_key"))
    chosen = marked.filter("n_shingles > 0").groupBy("group").agg(first.alias("first")).select("first.row_key", F.lit(1).alias("copies"))
    empty = marked.filter("n_shingles = 0").select("row_key", F.lit(None).cast("int").alias("copies")).distinct()
    key, copies, copy = (free_name(docs, name) for name in ("chosen_key", "copies", "copy_no"))
    chosen = chosen.unionByName(empty).select(F.col("row_key").alias(key), F.col("copies").alias(copies))
    numbered = docs.withColumn(key, row_key())
    others = [c for c in ("lang", "source", "n_chars") if c in docs.columns]
    alike = Window.partitionBy(key).orderBy(*(others or [key]))
    kept = numbered.join(chosen, key).withColumn(copy, F.row_number().over(alike))
    return kept.filter(F.col(copies).isNull() | (F.col(copy) <= F.col(copies))).select(*docs.columns)
