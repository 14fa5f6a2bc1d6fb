"""Language identification by Bayesian evidence fusion.

Three kinds of evidence meet: the text under a model of hashed character trigrams per language, the language a
page's markup declares (with the reliability such declarations were found to have), and what is known of the
host. A host's prior leans on its domain's, that on its address suffix', that on the whole corpus', each level
with the counts of the one below, summed by grouped aggregation. A page's own share is taken out of its host's
counts, so it does not confirm itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmart.llm.staging import stage
from talkmart.llm.text import free_name

CELLS = 1 << 14
#: Labelled documents the text model is fitted on, taken by the hash of their ids.
TRAINING_ROWS = 8_000
#: Share of a trigram's evidence that counts: neighbouring trigrams repeat each other.
TEMPER = 0.25
#: Weight of the level above, in pages.
CONCENTRATION = 8.0
#: Posterior from which a language is accepted.
ACCEPT = 0.5
UNKNOWN = "und"
#: Prior share of texts in none of the known languages; their trigrams are taken to be uniform.
UNKNOWN_SHARE = 0.01

_PLACES = 1_000_000  # posteriors are added as whole millionths, so sums do not depend on their order


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    log_shares: np.ndarray  # languages and the unknown, by cell


def _cells(text: str) -> np.ndarray:
    """Cells of the trigrams of a text's letters, in lower case, with one space for all else between words."""
    letters = "".join([c if c.isalpha() else " " for c in text.lower()])
    codes = np.frombuffer(f" {' '.join(letters.split())} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return np.empty(0, np.int64)
    mixed = (codes[:-2] * np.uint64(1_000_003) + codes[1:-1]) * np.uint64(1_000_003) + codes[2:]
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - 14)).astype(np.int64)


def fit_text_model(labelled: DataFrame, rows: int = TRAINING_ROWS) -> TextModel:
    """A model from (doc_id, text, lang). Uses whole texts of the ``rows`` documents whose ids have the least hashes."""
    labelled = labelled.filter("lang is not null and text is not null")
    ids = labelled.select("doc_id").filter("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = labelled.select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id", "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                cells = found.setdefault(lang.as_py(), np.zeros(CELLS, np.int64))
                cells += np.bincount(_cells(text.as_py()), minlength=CELLS)
        for lang, cells in found.items():
            some = np.flatnonzero(cells)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(some), "cell": some, "n": cells[some]})

    sums = sample.select("text", "lang").mapInArrow(count, "lang string, cell long, n long")
    table = sums.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()  # languages times cells at most
    languages = tuple(sorted(table["lang"].unique()))
    counts = np.full((len(languages) + 1, CELLS), 0.1)
    for i, lang in enumerate(languages):
        own = table[table["lang"] == lang]
        counts[i, own["cell"].to_numpy(np.int64)] += own["n"].to_numpy(np.float64)
    counts[-1] = 1.0
    return TextModel(languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float64))


def page_text(html: Column) -> Column:
    """The text between tags, without scripts and styles: enough to tell the language."""
    plain = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?[A-Za-z0-9]+;", " ")
    return plain


def declared_language(html: Column) -> Column:
    """The primary language tag of the html element, in lower case, or NULL."""
    tag = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})", 1))
    return F.when(tag != "", tag)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def _prior(size: int) -> np.ndarray:
    return np.log(np.append(np.full(size, (1 - UNKNOWN_SHARE) / max(size, 1)), UNKNOWN_SHARE))


def _texts_scored(model: TextModel):
    size = len(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros((batch.num_rows, size + 1))
            for i, text in enumerate(batch["text"]):
                cells = _cells(text.as_py() or "")
                scores[i] = TEMPER * (model.log_shares @ np.bincount(cells, minlength=CELLS)) if len(cells) else 0
            shares = np.rint(_softmax(scores + _prior(size)) * _PLACES).astype(np.int64)
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            lists = [pa.array(list(scores), pa.list_(pa.float64())), pa.array(list(shares), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*kept, *lists], names=[*names, "scores", "shares"])

    return run


def _sums(rows: DataFrame, size: int, *by: str) -> DataFrame:
    totals = [F.sum(F.get("shares", F.lit(i))) for i in range(size + 1)]
    return rows.groupBy(*by).agg(F.array(*totals).alias("total"))


def identify(rows: DataFrame, model: TextModel, accept: float = ACCEPT) -> DataFrame:
    """``rows`` (key, text, declared, host, domain, suffix) with lang, probability, text_lang and accepted; no text.

    ``key`` may be any type and need not be unique; rows stay one to one. NULL or empty texts bring no evidence of
    their own: the declared language and the host decide. ``declared`` may be NULL (no evidence) or a tag the model
    does not know (one class of its own). NULL hosts count as one host without a name. Ties go to the language that
    comes first by name. A row is accepted if its language is known and has a posterior of ``accept`` or more.
    """
    size = len(model.languages)
    known = F.when(F.col("declared").isNull(), F.lit(None)).when(F.col("declared").isin(*model.languages), F.col("declared")).otherwise("other")
    named = rows.select(
        "key",
        "text",
        known.alias("declared"),
        *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("host", "domain", "suffix")),
    )
    shape = f"key {dict(named.dtypes)['key']}, declared string, host string, domain string, suffix string, scores array<double>, shares array<long>"
    scored = stage(named.mapInArrow(_texts_scored(model), shape), "language-scores")

    # How often each declaration goes with each language of the texts: a table of (languages + 1) squared numbers.
    seen = {r["declared"]: np.array(r["total"], np.float64) / _PLACES for r in _sums(scored.filter("declared is not null"), size, "declared").collect()}
    tags = [*model.languages, "other"]
    table = np.stack([seen.get(tag, np.zeros(size + 1)) for tag in tags]) + 0.5
    reliability = np.log(table / table.sum(axis=0, keepdims=True))

    hosts = stage(_sums(scored, size, "host", "domain", "suffix").withColumnRenamed("total", "host_total"), "hosts")
    upper = hosts.withColumnRenamed("host_total", "shares")
    domains = _sums(upper, size, "domain", "suffix").withColumnRenamed("total", "domain_total")
    suffixes = _sums(upper, size, "suffix").withColumnRenamed("total", "suffix_total")
    everything = _sums(upper, size).first()  # one row
    everywhere = np.array([x or 0 for x in everything["total"]], np.float64) / _PLACES
    everywhere = (everywhere + np.exp(_prior(size))) / (everywhere.sum() + 1)
    levels = hosts.join(domains, ["domain", "suffix"]).join(suffixes, "suffix")
    place = {tag: i for i, tag in enumerate(tags)}
    names = np.array([*model.languages, UNKNOWN], object)

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = lambda batch, name: np.stack(batch[name].to_pylist()).astype(np.float64)
        for batch in batches:
            if not batch.num_rows:
                continue
            scores, own = matrix(batch, "scores"), matrix(batch, "shares") / _PLACES
            prior = np.tile(everywhere, (batch.num_rows, 1))
            for level in ("suffix_total", "domain_total", "host_total"):
                counts = np.maximum(matrix(batch, level) / _PLACES - own, 0)
                prior = (counts + CONCENTRATION * prior) / (counts.sum(axis=1, keepdims=True) + CONCENTRATION)
            evidence = scores + np.log(np.maximum(prior, 1e-12))
            for i, tag in enumerate(batch["declared"].to_pylist()):
                if tag is not None:
                    evidence[i] += reliability[place[tag]]
            posterior = np.round(_softmax(evidence), 6)
            best = posterior.argmax(axis=1)
            text_best = own.argmax(axis=1)
            top = posterior[np.arange(len(best)), best]
            columns = [
                batch["key"],
                batch["declared"],
                pa.array(names[best], pa.string()),
                pa.array(top),
                pa.array(names[text_best], pa.string()),
                pa.array((best < size) & (top >= accept)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "declared", "lang", "probability", "text_lang", "accepted"])

    out = f"key {dict(named.dtypes)['key']}, declared string, lang string, probability double, text_lang string, accepted boolean"
    return scored.join(levels, ["host", "domain", "suffix"]).mapInArrow(fuse, out)


def identify_pages(pages: DataFrame, model: TextModel, accept: float = ACCEPT) -> DataFrame:
    """``identify`` for pages (page_id, url, html); the key is a struct of page_id and url."""
    name = host(F.col("url"))
    return identify(
        pages.select(
            F.struct("page_id", "url").alias("key"),
            page_text(F.col("html")).alias("text"),
            declared_language(F.col("html")).alias("declared"),
            name.alias("host"),
            domain(name).alias("domain"),
            suffix(name).alias("suffix"),
        ),
        model,
        accept,
    )


def identify_documents(docs: DataFrame, model: TextModel, key: Column, accept: float = ACCEPT) -> DataFrame:
    """``identify`` for documents: the source is the host, ``lang`` what was declared; there is no address."""
    none = F.lit(None).cast("string")
    declared = F.lower(F.col("lang").cast("string"))
    source = F.col("source").cast("string")
    return identify(
        docs.select(key.alias("key"), F.col("text").cast("string").alias("text"), declared.alias("declared"), source.alias("host"), none.alias("domain"), none.alias("suffix")),
        model,
        accept,
    )


def known_language(docs: DataFrame, model: TextModel, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, ``lang`` set to it; all other columns as they are."""
    mark = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NULL"))
    row = F.md5(F.concat_ws("|", mark("doc_id"), mark("lang"), mark("source"), F.coalesce("text", F.lit(""))).cast("binary"))
    found = identify_documents(docs, model, row, accept).filter("accepted")
    key, lang = free_name(docs, "language_key"), free_name(docs, "language_found")
    found = found.groupBy(F.col("key").alias(key)).agg(F.max("lang").alias(lang))  # equal rows have equal answers
    kept = docs.join(found, row == F.col(key))
    return kept.select(*(F.col(lang).alias("lang") if c == "lang" else docs[c] for c in docs.columns))
