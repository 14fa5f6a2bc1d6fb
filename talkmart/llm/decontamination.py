"""Benchmark decontamination: a prefix-filtered set join with exact containment.

Every benchmark item is cut into windows of 13 words (an item with fewer words is one window) and every
window is a set of five-word shingles at known offsets. A document contains a window only if it contains
all of its shingles, so one shingle per window is a sufficient prefix: the rarest over all documents. The
documents' shingles meet these prefix shingles only. Length and position bounds drop what would not fit,
and the words of the document at that place are compared with the words of the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmart.llm.staging import small, stage
from talkmart.llm.text import alnum_words, free_name, keyed, row_key, shingles

WINDOW = 13
SHINGLE = 5
SHARE = 20


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(window, items, width, shingle, offset, token): the shingles of each distinct window of the items."""
    words = alnum_words(F.col("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words"))
    items = items.filter(F.col("item_id").isNotNull() & (F.size("words") > 0)).withColumn("width", F.least(F.size("words"), F.lit(window)))
    place = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)).alias("place")
    placed = items.select("item_id", "words", "width", place)
    windows = (
        placed.select("item_id", F.slice("words", F.col("place"), F.col("width")).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item_id").alias("items"))
        .withColumn("width", F.size("window"))
        .withColumn("shingle", F.least(F.col("width"), F.lit(shingle)))
    )
    return windows.select(
        "window", "items", "width", "shingle", F.posexplode(shingles(F.col("window"), F.col("shingle"))).alias("offset", "token")
    )


def _tokens(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(row_key, words, shingle, place, token): the shingles of the documents in the sizes asked for."""
    words = docs.select("row_key", alnum_words(F.col("text")).alias("words"))

    def of(size: int) -> DataFrame:
        return words.select(
            "row_key", "words", F.lit(size).alias("shingle"), F.posexplode(shingles(F.col("words"), size)).alias("place", "token")
        )

    parts = [of(size) for size in sizes]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def prefixes(docs: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """The rarest shingle of each window, ties by offset. Rarity is counted over all documents."""
    wanted = windows.select("shingle", "token").distinct()
    counts = (
        _tokens(docs, sizes)
        .select("shingle", "token")
        .join(small(wanted), ["shingle", "token"])
        .groupBy("shingle", "token")
        .agg(F.count(F.lit(1)).alias("found"))
    )
    # A window with a shingle that no document has cannot occur: the inner join drops that shingle, the size check the window.
    rarest = Window.partitionBy("window").orderBy("found", "offset")
    return (
        windows.join(counts, ["shingle", "token"])
        .withColumn("order", F.row_number().over(rarest))
        .withColumn("known", F.count(F.lit(1)).over(Window.partitionBy("window")))
        .filter((F.col("order") == 1) & (F.col("known") == F.col("width") - F.col("shingle") + 1))
        .select("window", "items", "width", "shingle", "offset", "token")
    )


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(row_key, start, width, item_id): where windows of items stand in documents. ``docs`` comes from ``keyed``."""
    windows = stage(item_windows(benchmark, window, shingle), "item-windows")
    sizes = [row[0] for row in windows.select("shingle").distinct().collect()]  # at most SHINGLE numbers
    if not sizes:
        sizes = [shingle]
    prefix = stage(prefixes(docs, windows, sizes), "item-prefixes")
    start = F.col("place") - F.col("offset")
    fits = (start >= 0) & (start + F.col("width") <= F.size("words"))
    same = F.slice("words", F.when(fits, start + 1).otherwise(1), F.col("width")) == F.col("window")
    return (
        _tokens(docs, sizes)
        .join(small(prefix), ["shingle", "token"])
        .filter(fits & same)
        .select("row_key", start.alias("start"), "width", F.explode("items").alias("item_id"))
    )


def _covered(docs: DataFrame, benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """(row_key, n_hit, items) of the documents with an occurrence."""
    # The new words of an occurrence are those past the furthest end of all that start earlier.
    before = Window.partitionBy("row_key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("width")
    return (
        occurrences(docs, benchmark, window, shingle)
        .groupBy("row_key", "start")
        .agg(F.max("width").alias("width"), F.collect_set("item_id").alias("items"))
        .withColumn("reach", F.coalesce(F.max(end).over(before), F.lit(0)))
        .groupBy("row_key")
        .agg(
            F.sum(F.greatest(F.lit(0), end - F.greatest("start", "reach"))).alias("n_hit"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    )


def _verdict(n_words: Column, n_hit: Column, share: int) -> Column:
    return (n_hit > 0) & (share * n_hit >= n_words)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, share: int = SHARE
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (sorted strings), contaminated.

    A word inside any occurrence of a window is hit. A document is contaminated if some word is hit and the
    hit words are at least one in ``share``. NULL and empty texts have no words and are clean; so is every
    document when the benchmark is empty. Rows with the same id and text get equal answers; rows with a NULL
    id are kept. Items with a NULL id or no words are left out.
    """
    docs = keyed(docs)
    base = docs.select("doc_id", "row_key", F.size(alnum_words(F.col("text"))).cast("long").alias("n_words"))
    hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return base.join(_covered(docs, benchmark, window, shingle), "row_key", "left").select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        _verdict(F.col("n_words"), hit, share).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, share: int = SHARE
) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = _covered(keyed(docs), benchmark, window, shingle)
    key = free_name(docs, "found_key")
    hits = free_name(docs, "found_hits")
    found = found.select(F.col("row_key").alias(key), F.col("n_hit").alias(hits))
    n_words = F.size(alnum_words(F.col("text")))
    clean = F.col(hits).isNull() | ~_verdict(n_words, F.col(hits), share)
    return docs.join(found, row_key() == F.col(key), "left").filter(clean).select(*[docs[c] for c in docs.columns])
