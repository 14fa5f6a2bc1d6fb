"""The n-gram join against all pairs in plain Python."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkmart.llm import components, jaccard
from tests.llm import plain


def brute(rows):
    sets = []
    for _, text in rows:
        words = plain.spaced(text, lower=True)
        n = min(5, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    holders = {}
    for i, own in enumerate(sets):
        shared = Counter(j for g in own for j in holders.get(g, ()))
        for j, n in shared.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                group[root(i)] = root(j)
        for g in own:
            holders.setdefault(g, []).append(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least.get(root(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)]


def near_copies(rng):
    """Groups around a text, chains in which only neighbours link, texts that share a long passage, odd texts."""
    word = lambda: f"w{rng.randint(0, 10**6)}"
    texts = list(plain.ODD)
    for size, edits in ((40, 1), (30, 2), (12, 4)):
        base = [word() for _ in range(rng.randint(40, 120))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    chain = [word() for _ in range(60)]
    for _ in range(12):
        texts.append(" ".join(chain).upper())
        chain = chain[2:] + [word(), word()]
    passage = [word() for _ in range(50)]
    for own in list(range(1, 16)) + [40] * 20:
        texts.append(" ".join(passage + [word() for _ in range(own)]))
    texts += ["a b c d", "A b c d", "a b c", "a b c d e", "a b c d e"] * 2
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_all_links(spark, seed):
    rng = random.Random(seed)
    texts = near_copies(rng)
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts, strict=True)) + [(ids[0], texts[0]), (None, texts[1]), (None, None), (None, "only here and nowhere else at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit(1)).withColumn("n", F.lit("x")).repartition(5)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def weak_links(rng):
    """Chains and trees of 25 to 60 texts whose neighbours are only 0.80 to 0.83 alike."""
    texts = []
    for kind, size, words in (("chain", 60, 130), ("tree", 60, 130), ("chain", 40, 220), ("tree", 40, 220), ("tree", 25, 90), ("chain", 25, 90)) * 3:
        word = lambda: f"v{rng.randint(0, 10**7)}"
        made = [[word() for _ in range(words)]]
        while len(made) < size:
            copy = list(made[-1] if kind == "chain" else rng.choice(made))
            # d of n shingles changed: (n - d) / (n + d) is 0.80 to 0.83; words far apart change five shingles each.
            n, places = words - 4, []
            while (n - 5 * len(places) - 5) / (n + 5 * len(places) + 5) >= 0.8:
                place = rng.randrange(5, words - 5)
                if all(abs(place - p) > 5 for p in places):
                    places.append(place)
            for place in places:
                copy[place] = word()
            made.append(copy)
        texts += [" ".join(words) for words in made]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [5])
def test_links_just_above_the_bound(spark, seed):
    rows = list(enumerate(weak_links(random.Random(seed))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_a_crowd_that_is_not_alike_is_not_paired(spark, monkeypatch):
    """150 texts with two words of their own in a common one of 100 are some 0.65 alike and share much of their prefixes."""
    rng, base, texts = random.Random(7), [f"c{i}" for i in range(100)], []
    for i in range(150):
        copy = list(base)
        for place in (rng.randrange(5, 45), rng.randrange(55, 95)):
            copy[place] = f"own{i}at{place}"
        texts.append(" ".join(copy))
    staged, stage = [], jaccard.stage

    def counted(df, name):
        out = stage(df, name)
        staged.append((name, out.count()))
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    rows = list(enumerate(texts))
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(brute(rows))
    assert sum(n for name, n in staged if name == "pairs") < 5 * len(rows)


@pytest.mark.parametrize(("n", "m", "common"), [(90, 90, 80), (400, 400, 356), (700, 600, 520), (30_000, 28_000, 26_000), (1, 1, 1)])
def test_marks_differ_by_no_more_than_the_sets(n, m, common):
    rng = np.random.default_rng(n)
    tokens = rng.integers(0, 2**64, n + m - common, np.uint64)
    low, high = jaccard._mark(tokens[:n]), jaccard._mark(tokens[n - common :])
    size = min(len(low), len(high))
    for bits in (size, jaccard.MARK_BITS // 8):
        differ = np.bitwise_count(jaccard._folded(low, bits) ^ jaccard._folded(high, bits)).sum()
        assert differ <= n + m - 2 * common


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_duplicates(docs).collect() == []


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(rng.randint(500, 900), rng.randint(500, 900)) for _ in range(300)]
    links += [(5, 5), (200, 7), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    group = {n: n for link in links if None not in link and link[0] != link[1] for n in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a in group and b in group and a != b and group[a] != group[b]:
                group[a] = group[b] = min(group[a], group[b])
                changed = True
    assert got == group
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_postings_are_narrow_and_no_task_holds_two_python_workers(spark, monkeypatch):
    """Postings move by token several times, so they hold no marks. A task over a task would keep a second worker."""
    staged, stage = {}, jaccard.stage

    def kept(df, name):
        staged.setdefault(name, []).append((df.schema.names, df._jdf.queryExecution().executedPlan().toString()))
        return stage(df, name)

    monkeypatch.setattr(jaccard, "stage", kept)
    rows = list(enumerate(near_copies(random.Random(4))))
    assert jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).count() == len(rows)
    assert staged["postings"][0][0] == ["token", "class", "n", "place"]
    for _, plan in sum(staged.values(), []):
        chained = 0
        for line in plan.split("\n"):
            chained = 0 if any(x in line for x in ("Exchange", "Union", "Join", "Scan")) else chained + ("MapInArrow" in line)
            assert chained < 2
