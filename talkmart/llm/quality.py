"""Quality rules: counts of a text's shape, then a hashed n-gram log-likelihood ratio.

Words and pairs of words fall into a fixed number of buckets. Two multinomials over the buckets are counted:
one over the trusted documents, one over the whole corpus. A document's score is the mean log ratio of its
n-grams, so its length does not matter, and the same threshold decides on every document. Texts are read twice:
to count the buckets, and to measure and score each text within its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmart.functions.once import computed_once
from talkmart.llm.staging import BROADCAST_ROWS, stage
from talkmart.llm.text import space_words

BUCKETS = 16_384
#: Mean log ratio per n-gram below which a document is dropped.
THRESHOLD = -0.05
#: Counts added to each bucket, in shares of the corpus.
SMOOTHING = 1.0
MIN_WORDS = 50
#: Weights are added as whole millionths, so the sums do not depend on their order.
PARTS = 1_000_000


def _prepared(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``words``, the words of ``text``, cut once."""
    return computed_once(docs, keep, {"words": space_words(F.col("text"))})


def _runs(hashes: Column, width: int) -> Column:
    """A 64-bit hash of each run of ``width`` words, from the hashes of the words."""
    rest = F.slice(hashes, width, F.greatest(F.size(hashes), F.lit(1)))
    return F.transform(rest, lambda x, i: F.xxhash64(*(F.get(hashes, i + k) for k in range(width - 1)), x))


def _with_grams(docs: DataFrame, keep: list[str], buckets: int) -> DataFrame:
    """``keep`` and ``grams``: the bucket of each word and of each pair of neighbouring words, in lower case."""
    lowered = F.transform("words", lambda w: F.xxhash64(F.lower(w)))
    docs = computed_once(docs, keep, {"hashes": lowered})
    place = lambda h: F.pmod(h, F.lit(buckets)).cast("int")
    hashes = F.col("hashes")
    return computed_once(docs, keep, {"grams": F.concat(F.transform(hashes, place), F.transform(_runs(hashes, 2), place))})


def measured(docs: DataFrame, points: list[int]) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score) of each row, in one pass over the texts.

    ``points`` has a number of millionths per bucket; the score is the mean of those of a text's n-grams.
    """
    text = F.col("text")
    words = F.col("words")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    docs = _prepared(docs, ["doc_id", "text"])
    counts = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "lines": lines,
    }
    docs = computed_once(docs, ["doc_id", "words"], {**counts, "raw": F.transform(words, lambda w: F.xxhash64(w))})
    dup_lines = (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    docs = computed_once(docs, [*counts[:-1], "words"], {"n_dup_lines": dup_lines, "grams": _runs(F.col("raw"), 3)})
    grams = F.col("grams")
    placed = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    some = F.size(F.array_distinct(grams)) < F.size(grams)
    docs = computed_once(docs, [*counts, "words"], {"placed": F.when(some, placed).otherwise(none)})
    pairs = F.col("placed")
    twin = lambda x, other: F.coalesce(other["h"] == x["h"], F.lit(False))
    twins = F.filter(pairs, lambda x, i: twin(x, F.get(pairs, i - 1)) | twin(x, F.get(pairs, i + 1)))
    docs = computed_once(docs, [*counts, "words"], {"places": F.sort_array(F.transform(twins, lambda x: x["i"]))})
    places = F.col("places")
    # Each window adds its three words, or as many as lie before the next one.
    covered = F.aggregate(
        F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    counts.append("n_repeat_words")
    docs = computed_once(docs, [*counts[:-1], "words"], {"n_repeat_words": covered.cast("long")})
    # One constant of as many numbers as there are buckets, whatever the documents.
    table = F.split(F.lit(",".join(map(str, points))), ",").cast("array<bigint>")
    docs = _with_grams(docs, counts, len(points))
    total = F.aggregate("grams", F.lit(0).cast("long"), lambda a, g: a + F.get(table, g))
    size = F.size("grams")
    return docs.select(*counts, F.when(size > 0, total / size / PARTS).alias("score"))


def _with_target(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(text, is_target): all rows of ``docs``, ``is_target`` NULL where the id is not among the trusted ones.

    Few ids are broadcast. Many are shuffled and hashed, so that texts are shuffled but not sorted; rows with a NULL
    id, which are never trusted, get a key of their own and are dealt out.
    """
    ids = stage(trusted.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct(), "trusted-ids")
    sent = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids.hint("shuffle_hash")
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    keys = sent.select("doc_id", F.lit(0).cast("long").alias("spread"), F.lit(1).alias("is_target"))
    rows = docs.select("doc_id", "text", spread.alias("spread"))
    return rows.join(keys, ["doc_id", "spread"], "left").select("text", "is_target")


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, weight) for all buckets: log of the target's share over the corpus' share, smoothed.

    ``trusted`` has a doc_id per trusted document; all of them make the target. The corpus is every row of ``docs``.
    """
    counted = (
        _with_grams(_prepared(_with_target(docs, trusted), ["is_target"]), ["is_target"], buckets)
        .select("is_target", F.explode("grams").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("corpus"), F.count("is_target").alias("target"))
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    counted = stage(every.join(counted, "bucket", "left").fillna(0), "quality-counts")
    total = counted.agg(F.sum("corpus").alias("all_corpus"), F.sum("target").alias("all_target"))
    sums = total.first()  # two numbers
    share = lambda c, n: (F.col(c) + SMOOTHING) / F.lit(float((n or 0) + SMOOTHING * buckets))
    weight = F.log(share("target", sums["all_target"])) - F.log(share("corpus", sums["all_corpus"]))
    # Without any trusted words there is nothing to tell documents apart by.
    return counted.select("bucket", (weight if sums["all_target"] else F.lit(0.0)).alias("weight"))


def points(weights: DataFrame) -> list[int]:
    """The weight of each bucket in whole millionths; as many numbers as buckets."""
    rounded = weights.select("bucket", F.round(F.col("weight") * PARTS).cast("long").alias("points"))
    return [row.points for row in sorted(rounded.collect())]


def quality(
    docs: DataFrame,
    trusted: DataFrame,
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per document: doc_id, n_words, the four counts of ``measured``, base_failed, score, kept.

    ``base_failed``: fewer than ``min_words`` words, or more than half of them in repeated three-word windows.
    Other documents are kept when their score reaches ``threshold``. NULL and empty texts have no words, fail
    the base rules and have a NULL score. Rows with the same id and text get equal answers. With no trusted
    documents all scores are 0.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    weights = points(log_ratios(docs, trusted, buckets))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        measured(docs, weights)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False)))
    )
