"""Packing: whole, within every capacity, few sequences, and the ids come back."""

import functools
import random
import zlib

import numpy as np
import pandas as pd
import pytest

from talkmart.llm import packing
from talkmart.llm.packing import Capacity
from talkmart.llm.queries import QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"


def checked(rows, capacity):
    """Fails unless the places are gapless and no capacity is passed; the number of sequences."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for group in by.values():
        at = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        need = np.array([at, len(group), sum(r["length"] ** 2 for r in group)])
        assert (need <= capacity.vector()).all()
    return len(by)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("limits", [(None, None), (3, None), (None, 600), (4, 900)])
def test_every_capacity_holds(spark, rule, limits):
    capacity = Capacity(64, *limits, rule=rule)
    top = int(min(64, (limits[1] or 64**2) ** 0.5))
    rng = random.Random(5)
    lengths = [rng.choice([1, 2, 3, rng.randint(1, top), top]) for _ in range(700)]
    pieces = spark.createDataFrame([(i // 2, i % 2, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    rows = packing.pack(pieces, capacity).collect()
    assert sorted((r.doc_id, r.piece, r.length) for r in rows) == sorted((i // 2, i % 2, n) for i, n in enumerate(lengths))
    assert checked(rows, capacity) <= 1.5 * max(np.array([sum(lengths), len(lengths), sum(n * n for n in lengths)]) / capacity.vector()) + 2


def test_few_sequences():
    rng = random.Random(1)
    histogram = {n: rng.randint(0, 40) for n in range(1, 2049)}
    histogram = {n: c for n, c in histogram.items() if c}
    table = packing.plan(histogram, Capacity(2048))
    used = 1 + max(first + (pieces - 1) // each for (_, low, each, first, _), pieces in zip(table, _pieces(table, histogram), strict=True))
    least = sum(n * c for n, c in histogram.items()) / 2048
    assert used <= 1.01 * least + 1


def _pieces(table, histogram):
    for i, row in enumerate(table):
        last = i + 1 == len(table) or table[i + 1][0] != row[0]
        yield (histogram[row[0]] if last else table[i + 1][1]) - row[1]


@functools.cache
def reference():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def reference_ids(text):
    return [*reference().encode(text or "", add_special_tokens=False).ids, 0]


def wanted(rows):
    for doc_id, text in rows:
        ids = reference_ids(text)
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield doc_id, piece, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes())


def test_the_whole_table(spark):
    rows = QUERIES["op1_best_fit_packing"](spark, FOLDER).collect()
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == sorted(wanted(docs[["doc_id", "text"]].itertuples(index=False, name=None)))
    assert checked(rows, Capacity(2048)) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_odd_texts_and_round_trip(spark):
    texts = [None, "", " ", "a", "a  b", " a b", "a b ", "a\n b", "a \tb", "x <|endoftext|> y", "don't  it's 12 é中  z   q", "w " * 5000, "中文 字" * 900, "a b", "a b"]
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate(texts)] + [(None, "a", 1, "x")], "doc_id long, text string, length int, _rank string")
    packed = packing.pack_documents(docs, tokenizer_path())
    rows = packed.collect()
    key = lambda r: (r[0] is not None, *map(lambda x: x or 0, r))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(wanted([*enumerate(texts), (None, "a")]), key=key)
    checked(rows, Capacity(2048))
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in rows:
        own = whole[r.sequence_id]
        assert own.ids[4 * r.offset : 4 * (r.offset + r.length)] == r.ids and own.n_tokens == sum(own.lengths) <= 2048
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).collect() == []


def test_both_encoders_give_the_same_ids():
    coder = packing._coder(tokenizer_path())
    assert coder.quick is not None
    rng = random.Random(9)
    letters = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(161, 173), *range(174, 0x250)]]
    common = list(" \n'aeinrst,.0129#")
    for _ in range(3000):
        text = "".join(rng.choice(common if rng.random() < 0.7 else letters) for _ in range(rng.randint(0, 60)))
        assert not packing._UNUSUAL.search(text)
        assert np.frombuffer(coder.ids(text), "<u4").tolist() + [0] == reference_ids(text), repr(text)
    for text in pd.read_parquet("/root/testdata/sf0.01/documents.parquet").text:
        assert np.frombuffer(coder.ids(text), "<u4").tolist() + [0] == reference_ids(text)


def test_a_piece_that_fits_nowhere():
    with pytest.raises(ValueError):
        packing.plan({65: 1}, Capacity(64))
