"""Best-fit packing of tokenized documents into training sequences.

What decides where a piece may go is its vector: tokens, one document, attention cost (tokens squared). Pieces
of one length have equal vectors, so the plan is made over the histogram of lengths: lengths in descending
order, bins of equal contents as one interval, each step filling an interval's bins with as many pieces of a
length as fit. A step takes the interval that the pieces fit best among those with room in every capacity: least
weighted norm of what stays free, or least weighted dot product of piece and free room. The plan's size depends
on the capacity, not on the number of documents. Spark then ranks the pieces of each length and every piece
looks its place up by length and rank.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmart.llm.staging import stage

END_ID = 0
SPECIAL = "<|endoftext|>"
#: Pieces ranked in one group at most, give or take the spread of a hash.
SHARD_ROWS = 20_000

_PIECES = "doc_id long, piece int, start long, length long, ids binary"
# Fixed value: how a byte-level vocabulary cuts texts before merging.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters outside Latin letters, ASCII and its plain white space.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\u00a1-\u00ac\u00ae-\u024f]")
_CODERS: dict[str, _Coder] = {}


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds.

    Without limits of their own, documents and cost are bound by the tokens alone, and their free room says nothing
    about how well a piece fits: it has no weight then.
    """

    tokens: int = 2048
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.5, 0.5)
    rule: str = "norm"

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.cost or self.tokens**2], np.float64)


def _byte_names() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones themselves, others moved up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


def _quick(path: str):
    """The same vocabulary for a faster encoder, or None where the file has other rules than it follows."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    model, cut = rules["model"], rules.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    cuts = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    if not plain or not cuts or rules.get("normalizer"):
        return None
    names, special = _byte_names(), {t["content"] for t in rules.get("added_tokens", [])}
    if special - {SPECIAL}:
        return None
    vocabulary = {bytes(names[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    order = [model["vocab"]["".join(pair)] for pair in pairs]
    if order != sorted(order):  # it merges by ids
        return None
    return tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=vocabulary, special_tokens={})


class _Coder:
    """Ids of texts as little-endian 32-bit numbers, as the tokenizer file gives them.

    Texts of Latin letters and plain signs go to an encoder that is several times faster and gives the same ids.
    All others, for which two libraries may know different versions of Unicode, and texts with a special token go to
    the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.quick = _quick(path)

    def ids(self, text: str) -> bytes:
        if self.quick is not None and SPECIAL not in text and not _UNUSUAL.search(text):
            return self.quick.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _coder(path: str) -> _Coder:
    if path not in _CODERS:
        _CODERS[path] = _Coder(path)
    return _CODERS[path]


def tokenize(docs: DataFrame, tokenizer: str, tokens: int = 2048) -> DataFrame:
    """(doc_id, piece, start, length, ids): each document's ids and an end id, cut from the end into full pieces.

    ``ids`` are little-endian unsigned 32-bit numbers. Only documents of more than ``tokens`` ids are cut; their
    first piece may be shorter. ``tokenizer`` is the path of a vocabulary file that every executor has. NULL and
    empty texts give one piece with the end id alone. Repeated rows give their pieces again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer)
        end = np.asarray([END_ID], "<u4").tobytes()
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            rows, pieces, starts, ids = [], [], [], []
            for row, text in enumerate(batch["text"]):
                own = coder.ids(text.as_py() or "") + end
                n = len(own) // 4
                cuts = [0, *range((n % tokens) or tokens, n + 1, tokens)]
                for piece, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(low)
                    ids.append(own[4 * low : 4 * high])
            columns = [batch["doc_id"].take(pa.array(rows, pa.int64())), pieces, starts, [len(x) // 4 for x in ids], ids]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, _PIECES)


def plan(histogram: dict[int, int], capacity: Capacity) -> np.ndarray:
    """Rows of (length, first rank, pieces a bin, first bin, offset), sorted by length and rank.

    The pieces of a length with ranks from a row's first to the next row's go to bins from ``first bin`` on, so
    many to a bin, one after another from ``offset``.
    """
    room = capacity.vector()
    limited = np.array([True, capacity.documents is not None, capacity.cost is not None])
    weights = np.asarray(capacity.weights) * limited / room**2
    size = 1024
    free, first, count = np.zeros((size, 3)), np.zeros(size, np.int64), np.zeros(size, np.int64)
    used, bins, steps = 0, 0, []

    def add(state: np.ndarray, start: int, many: int) -> None:
        nonlocal free, first, count, used
        if used == len(first):
            free, first, count = np.concatenate([free, np.zeros_like(free)]), np.append(first, np.zeros_like(first)), np.append(count, np.zeros_like(count))
        free[used], first[used], count[used] = state, start, many
        used += 1

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        item = np.array([length, 1.0, float(length) ** 2])
        if (item > room).any():
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left:
            fits = np.flatnonzero((free[:used] >= item).all(axis=1) & (count[:used] > 0))
            if len(fits):
                rest = free[fits] - item
                points = (weights * rest**2 if capacity.rule == "norm" else weights * item * free[fits]).sum(axis=1)
                best = fits[np.argmin(points)]
                state, start, many = free[best].copy(), int(first[best]), int(count[best])
            else:
                best, state, start, many = -1, room, bins, -(-left // int((room // item).min()))
                bins += many
            each = min(left, int((state // item).min()))
            taken = min(many, left // each)
            steps.append((length, rank, each, start, int(room[0] - state[0])))
            rank, left = rank + taken * each, left - taken * each
            if best >= 0:  # the bins filled leave the interval's front
                first[best], count[best] = start + taken, many - taken
            elif many > taken:
                add(state, start + taken, many - taken)
            add(state - each * item, start, taken)
        live = np.flatnonzero(count[:used] > 0)  # used-up intervals and full bins go
        live = live[free[live, 0] > 0]
        if len(live) < used:
            free[: len(live)], first[: len(live)], count[: len(live)] = free[live], first[live], count[live]
            used = len(live)
    table = np.array(steps, np.int64).reshape(-1, 5)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pack(pieces: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """``pieces`` with sequence_id and offset: every row has a place, places in a sequence are gapless from 0.

    Needs doc_id, piece and length (from 1 to the capacity's tokens); other columns stay. ``pieces`` is read twice,
    pass a staged table. Rows alike in id and piece are told apart by rank only, which of them goes where does not
    matter.
    """
    total = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # as many rows as lengths
    table = plan({int(r["length"]): r["n"] for r in total}, capacity)
    shards = 1 + sum(r["n"] for r in total) // SHARD_ROWS
    spread = pieces.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)))
    before = Window.partitionBy("length").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = spread.groupBy("length", "_shard").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("length", "_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    others = sorted(c for c in pieces.columns if c not in ("doc_id", "piece"))
    inside = Window.partitionBy("length", "_shard").orderBy("doc_id", "piece", *others)
    ranked = spread.withColumn("_rank", F.row_number().over(inside) - 1).join(counts, ["length", "_shard"])
    ranked = ranked.withColumn("_rank", (F.col("_rank") + F.col("_before")).cast("long")).select(*pieces.columns, "_rank")

    keys = table[:, 0] << 44 | table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["length"].to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch["_rank"].to_numpy(zero_copy_only=False)
            row = table[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            index = rank - row[:, 1]
            added = [pa.array(row[:, 3] + index // row[:, 2]), pa.array(row[:, 4] + index % row[:, 2] * length)]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(kept + added, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{shape}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), keep_ids: bool = True) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids.

    ``keep_ids=False`` leaves the ids out of the staged table and the shuffles; their checksum stays. An empty
    table gives no rows; other columns of ``docs`` go.
    """
    pieces = tokenize(docs, tokenizer, capacity.tokens).withColumn("ids_crc32", F.crc32("ids"))
    return pack(stage(pieces if keep_ids else pieces.drop("ids"), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids, lengths): the packed ids of each sequence in order, bounded by the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts.ids", F.lit("").cast("binary"), lambda whole, x: F.concat(whole, x))
    n_tokens = F.aggregate("parts.length", F.lit(0).cast("long"), lambda n, x: n + x)
    return rows.select("sequence_id", n_tokens.alias("n_tokens"), ids.alias("ids"), F.col("parts.length").alias("lengths"))
