"""The prefix trie against dictionaries of whole beginnings."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from talkmart.llm.prefix_trie import prefix_trie
from tests.llm.plain import spaced

SHAPE = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members, children = defaultdict(list), Counter()
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children.update(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not children[p]
        if p:
            saved[p] += (len(members[p]) - 1) * len(spaced(p[-1][1]))
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    out = Counter()
    for p, convs in members.items():
        ends = ",".join(str(c) for c in convs if len(whole[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        out[(convs[0], len(p), parent, len(convs), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def figures(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def made(seed, conversations, longest, kinds):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(conversations * 2), conversations):
        for turn in range(rng.randint(1, longest)):
            text = " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, kinds)))
            rows.append((c, turn * 3 + rng.randint(0, 2), rng.choice(["user", "assistant"]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [1, 7, 40, 100_000])
def test_shards_of_any_size_give_the_same_nodes(spark, shard_turns):
    rows = made(shard_turns, 90, 6, 2)
    assert figures(prefix_trie(spark.createDataFrame(rows, SHAPE), shard_turns)) == brute(rows)


def test_copies_over_many_shards_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(1000, 1300) for t in range(5)]
    rows += [(7, t, "user", f"step {t % 3}") for t in range(2500)] + [(9, t, "user", f"step {t % 3}") for t in range(2600)]
    assert figures(prefix_trie(spark.createDataFrame(rows, SHAPE), 100)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "belongs to nobody"),
        (20, None, None, None),
        (20, 1, "", ""),
        (21, 2, "user", "a b"),
        (21, 2, "user", "a b"),  # repeated: a turn of its own
        (21, None, "user", "first"),
        (35, 1, "user", "only"),
        (36, 1, "user", "only"),
        (37, 1, "user", "x " * 50_000),
        (38, 1, "us", "erx"),
        (39, 1, "user", "x"),
    ]
    conversations = spark.createDataFrame([(*r, "k", 1) for r in rows], SHAPE + ", codes string, depth int")
    assert figures(prefix_trie(conversations)) == brute(rows)
    assert prefix_trie(conversations.limit(0)).collect() == []


def test_given_tables(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    assert figures(prefix_trie(conversations, 64)) == brute(rows)
