"""Conversation prefix trie: what a cache of shared conversation beginnings would save.

Every conversation is a sequence of 128-bit turn codes. The sequences are sorted and dealt into range shards. A task
numbers its shard's codes in order and inserts its distinct sequences, the median of each range first, into a
ternary search tree; one walk over the nodes from the last made to the first adds up members, leaves and savings.

Only the nodes on the path of a shard's first and last sequence can have members in other shards. For those a task
gives what its shard adds to them, and a merge over the shards in order puts them together with a stack as deep as
the longest path. All other nodes are complete where they were made.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmart.llm.staging import small, stage
from talkmart.llm.text import space_words

#: Conversations are linked in runs of this many ids, and take up to HEADS - 1 turns from the first of their run.
RUN, HEADS = 20, 4
#: Turns of a shard, on average. A task holds one shard's codes.
SHARD_TURNS = 8192
#: Rows of nodes a task gives at once.
_ROWS = 4096

_NODE = pa.schema(
    [
        ("shard", pa.int32()),
        ("step", pa.int32()),
        ("node", pa.binary()),
        ("parent", pa.binary()),
        ("depth", pa.int64()),
        ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("words", pa.int64()),
        ("ends_sha256", pa.string()),
        ("ends", pa.string()),
    ]
)
_SHAPE = (
    "shard int, step int, node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string, ends string"
)
_FIGURES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns (turn, a, b, words) in order, NULL turns first.

    a and b are two hashes of role and text; the texts go no further. Turns with the same number are ordered by them.
    Rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            F.xxhash64(role, text).alias("a"),
            F.xxhash64(F.lit("turn"), text, role).alias("b"),
            F.size(space_words(F.col("text").cast("string"))).alias("words"),
        ).alias("t"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(lists: DataFrame) -> DataFrame:
    """(conv_id, codes, words): the first turns of the run's first conversation, then the own ones after as many.

    ``codes`` has two numbers per turn. The first conversation of a run may be missing; it gives no turns then.
    """
    heads = lists.filter(F.col("conv_id") % RUN == 0)
    heads = heads.select(F.col("conv_id").alias("first"), F.slice("turns", 1, HEADS - 1).alias("head"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    own = lists.withColumn("first", F.col("conv_id") - F.col("conv_id") % RUN).withColumn("taken", taken)
    both = own.join(heads, "first", "left")
    head = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("taken"))).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns") - F.col("taken"), F.lit(0)))
    turns = both.select("conv_id", F.concat(head, rest).alias("turns"))
    return turns.select("conv_id", F.flatten(_each("turns", lambda t: F.array(t["a"], t["b"]))).alias("codes"), _each("turns", lambda t: t["words"]).alias("words"))


def _each(name: str, of) -> Column:
    return F.transform(name, of)


class _Tree:
    """A ternary search tree of turn numbers; each of its nodes is a trie node, 0 the root."""

    def __init__(self) -> None:
        self.key, self.parent, self.depth, self.words = [0], [-1], [0], [0]
        self.low, self.high, self.down = [-1], [-1], [-1]
        self.ends: dict[int, list[int]] = {}

    def _new(self, key: int, parent: int, words: int) -> int:
        for column, value in ((self.key, key), (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.words, words)):
            column.append(value)
        for column in (self.low, self.high, self.down):
            column.append(-1)
        return len(self.key) - 1

    def insert(self, keys: list[int], words: list[int]) -> int:
        """The node of a sequence, made where it is new."""
        at = 0
        for key, n in zip(keys, words, strict=True):
            here = self.down[at]
            if here < 0:
                here = self.down[at] = self._new(key, at, n)
            while self.key[here] != key:
                side = self.low if key < self.key[here] else self.high
                if side[here] < 0:
                    side[here] = self._new(key, at, n)
                here = side[here]
            at = here
        return at

    def path(self, node: int) -> list[int]:
        """The nodes from the root to ``node``."""
        out = []
        while node >= 0:
            out.append(node)
            node = self.parent[node]
        return out[::-1]


def _medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of each range before its halves."""
    ranges = deque([(0, n)])
    while ranges:
        low, high = ranges.popleft()
        if low < high:
            middle = (low + high) // 2
            yield middle
            ranges += ((low, middle), (middle + 1, high))


def _numbered(codes: np.ndarray) -> np.ndarray:
    """Numbers of the turn codes (pairs), in the order that Spark sorts them by."""
    pairs = np.ascontiguousarray(codes.reshape(-1, 2)).view([("a", np.int64), ("b", np.int64)]).ravel()
    return np.unique(pairs, return_inverse=True)[1].ravel()


def _shard_tree(batches: list[pa.RecordBatch]) -> tuple[_Tree, int, int, np.ndarray, np.ndarray]:
    """The tree of a shard's sorted rows, the nodes of its first and last sequence, and these sequences' codes."""
    table = pa.Table.from_batches(batches).combine_chunks()
    ids, lists, words = (table[c].combine_chunks() for c in ("conv_id", "codes", "words"))
    ids, codes = ids.to_numpy(), lists.flatten().to_numpy()
    ends = np.cumsum(lists.value_lengths().to_numpy())
    starts = ends - lists.value_lengths().to_numpy()
    numbers, words = _numbered(codes), words.flatten().to_numpy()
    rows = [numbers[a // 2 : b // 2].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    first = [i for i in range(len(rows)) if not i or rows[i] != rows[i - 1]]
    bounds = [*first, len(rows)]
    tree, node_of = _Tree(), [0] * len(first)
    for k in _medians(len(first)):
        a, b = starts[first[k]] // 2, ends[first[k]] // 2
        node_of[k] = tree.insert(numbers[a:b].tolist(), words[a:b].tolist())
        tree.ends[node_of[k]] = ids[bounds[k] : bounds[k + 1]].tolist()
    return tree, node_of[0], node_of[-1], codes[starts[0] : ends[0]], codes[starts[-1] : ends[-1]]


def _names(codes: np.ndarray) -> list[bytes]:
    """A digest of each beginning of a sequence, the empty one first."""
    digest, out, raw = hashlib.md5(usedforsecurity=False), [], codes.astype("<i8").tobytes()
    out.append(digest.digest())
    for at in range(0, len(raw), 16):
        digest.update(raw[at : at + 16])
        out.append(digest.digest())
    return out


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard: whole figures, or for the nodes of its outer paths what this shard adds to them."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    tree, first, last, first_codes, last_codes = _shard_tree(batches)
    shard, n = TaskContext.get().partitionId(), len(tree.key)
    name: dict[int, bytes] = {}
    for node, codes in ((first, first_codes), (last, last_codes)):
        name.update(zip(tree.path(node), _names(codes), strict=True))
    step = {node: i for i, node in enumerate(dict.fromkeys([*tree.path(first), *tree.path(last)]))}

    members, least = [0] * n, [0] * n
    leaves, saved, children = [0] * n, [0] * n, [0] * n
    for node in range(n - 1, -1, -1):  # children were made after their parents
        own = tree.ends.get(node)
        if own:
            least[node] = min(least[node], own[0]) if members[node] else own[0]
            members[node] += len(own)
        parent = tree.parent[node]
        if node not in name:
            leaves[node] += not children[node]
            saved[node] += (members[node] - 1) * tree.words[node]
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
            children[parent] += 1
        if parent >= 0:
            least[parent] = min(least[parent], least[node]) if members[parent] else least[node]
            members[parent] += members[node]

    rows = []
    for node in range(n):
        outer, parent = node in name, tree.parent[node]
        ends = ",".join(map(str, tree.ends.get(node, ())))
        rows.append(
            {
                "shard": shard if outer else None,
                "step": step.get(node),
                "node": name.get(node),
                "parent": name.get(parent),
                "depth": tree.depth[node],
                "conv_id": least[node],
                "parent_conv_id": least[parent] if parent >= 0 and parent not in name else None,
                "n_convs": members[node],
                "n_children": children[node],
                "n_leaves": leaves[node],
                "saved_tokens": saved[node],
                "words": tree.words[node],
                "ends_sha256": None if outer else hashlib.sha256(ends.encode()).hexdigest(),
                "ends": ends if outer else None,
            }
        )
        if len(rows) == _ROWS:
            yield pa.RecordBatch.from_pylist(rows, schema=_NODE)
            rows = []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_NODE)


@dataclass
class _Open:
    """A node of an outer path while shards still add to it."""

    row: dict
    digest: object = field(default_factory=hashlib.sha256)
    any_ends: bool = False

    def add(self, row: dict) -> None:
        for column in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            self.row[column] += row[column]
        self.row["conv_id"] = min(self.row["conv_id"], row["conv_id"])

    def take_ends(self, ends: str) -> None:
        if ends:
            self.digest.update(("," if self.any_ends else "").encode() + ends.encode())
            self.any_ends = True


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole figures of the outer nodes, from the rows of all shards in order; the stack holds one path."""
    stack: list[_Open] = []
    done: list[dict] = []

    def close(depth: int) -> None:
        while len(stack) > depth:
            top = stack.pop()
            row = top.row
            row["n_leaves"] += not row["n_children"]
            row["saved_tokens"] += (row["n_convs"] - 1) * row["words"]
            row["ends_sha256"] = top.digest.hexdigest()
            if stack:
                for column in ("n_leaves", "saved_tokens"):
                    stack[-1].row[column] += row[column]
            done.append(row)

    def given() -> Iterator[pa.RecordBatch]:
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_NODE)
            done.clear()

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            depth, ends = row["depth"], row.pop("ends")
            row["ends"] = None
            if len(stack) > depth and stack[depth].row["node"] == row["node"]:
                stack[depth].add(row)
            else:
                close(depth)
                if stack:
                    stack[-1].row["n_children"] += 1
                stack.append(_Open(row))
            stack[depth].take_ends(ends)
        yield from given()
    close(0)
    yield from given()


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per distinct beginning of a rebuilt conversation, the empty one included.

    Columns: conv_id (smallest member), depth, parent_conv_id (NULL at the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. NULL role or text counts as empty, NULL turns come first, rows without conv_id are in
    no conversation, repeated rows are turns of their own, further columns go. An empty table gives no rows. One
    conversation's codes (28 bytes a turn) are one value, as a document's text is; members of a beginning are never
    collected: copies of one conversation are dealt over shards by conv_id, and their ids are hashed as they pass.
    """
    lists = stage(turn_lists(conversations), "turn-lists")
    sequences = stage(rebuilt(lists), "sequences")
    turns = sequences.agg(F.sum(F.size("words") + 1).alias("turns")).first()["turns"] or 0
    shards = sequences.repartitionByRange(max(1, -(-turns // shard_turns)), "codes", "conv_id")
    nodes = stage(shards.sortWithinPartitions("codes", "conv_id").mapInArrow(_shard, _SHAPE), "trie-nodes")

    outer = nodes.filter(F.col("node").isNotNull()).repartition(1).sortWithinPartitions("shard", "step")
    outer = stage(outer.mapInArrow(_merge, _SHAPE), "trie-outer")
    parents = outer.select(F.col("node").alias("parent"), F.col("conv_id").alias("outer_parent"))
    inner = nodes.filter(F.col("node").isNull())
    open_rows = outer.unionByName(inner.filter(F.col("parent").isNotNull()))
    placed = open_rows.join(small(parents), "parent", "left").withColumn("parent_conv_id", F.col("outer_parent"))
    return inner.filter(F.col("parent").isNull()).select(*_FIGURES).unionByName(placed.select(*_FIGURES))
