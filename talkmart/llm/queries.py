"""Named queries of this subpackage and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmart.llm import (
    decontamination,
    extraction,
    jaccard,
    language,
    licenses,
    packing,
    pii,
    prefix_trie,
    quality,
    quality_net,
    secrets,
    toxicity,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def tokenizer_path() -> str:
    """The vocabulary file of the installed tokenizers package that the packing query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    # As few sequences as can be: documents and attention cost are bound by the tokens alone.
    return packing.pack_documents(_table(spark, folder, "documents"), tokenizer_path(), packing.Capacity(2048), keep_ids=False)


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    model = language.fit_text_model(_table(spark, folder, "documents"))
    out = language.identify_pages(_table(spark, folder, "pages"), model)
    return out.select("key.page_id", "key.url", "declared", "text_lang", "lang", "probability", "accepted")


@query
def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return extraction.extract(pages, extraction.train(pages))


@query
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    out = decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    out = pii.personal_data(_table(spark, folder, "documents"))
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select(
        "doc_id",
        *(number(kind) for kind in ("email", "ip", "card", "phone", "iban", "local_phone", "ssn")),
        F.sha2(pii.marks(pii.base_only(F.col("spans"))), 256).alias("base_sha256"),
        pii.marks(F.col("spans")).alias("spans"),
    )


@query
def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licenses(_table(spark, folder, "documents"))


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query
def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    out = secrets.scan(_table(spark, folder, "documents"))
    return out.select("doc_id", "start", "end", F.sha2("raw", 256).alias("fingerprint"), "score", "is_secret")


@query
def op9_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    out = jaccard.near_duplicates(_table(spark, folder, "documents"))
    return out.select("doc_id", "n_shingles", "component_id")


@query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    trusted = _table(spark, folder, "labels").filter("quality = 1")
    out = quality.quality(_table(spark, folder, "documents"), trusted)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select("doc_id", *counts, "base_failed", "score", "kept")


@query
def op11_quality_net(spark: SparkSession, folder: str) -> DataFrame:
    return quality_net.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"))


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


SQL["op4_decontamination"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dg AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
occ AS (SELECT r, i, n, item_id FROM dg JOIN win USING (n, g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM occ) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id FROM occ) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

SQL["op9_ngram_jaccard"] = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
keyed AS (SELECT r, md5(string_agg(g, chr(10) ORDER BY g)) AS k FROM s GROUP BY r),
rep AS (SELECT k, min(r) AS r FROM keyed GROUP BY k),
c AS (SELECT s.* FROM s JOIN rep USING (r)),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS o FROM c a JOIN c b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
link AS (SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT r AS a, r AS b FROM rep UNION SELECT reach.a, l.b FROM reach JOIN both_ways l ON l.a = reach.b),
least AS (SELECT k, min(doc_id) AS doc_id FROM keyed JOIN d USING (r) GROUP BY k),
comp AS (SELECT x.k, min(least.doc_id) AS component_id FROM reach JOIN rep x ON x.r = reach.a JOIN rep y ON y.r = reach.b JOIN least ON least.k = y.k GROUP BY x.k)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN keyed USING (r) LEFT JOIN comp USING (k)
"""

# The byte table of the checksum is worked out bit by bit; each conversation's id then takes one step per digit.
SQL["op12_prefix_trie"] = r"""
WITH RECURSIVE bit_steps AS (SELECT range AS byte, CAST(range AS BIGINT) AS v, 0 AS bits FROM range(256)
  UNION ALL SELECT byte, xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END), bits + 1 FROM bit_steps WHERE bits < 8),
bytes AS (SELECT byte, v FROM bit_steps WHERE bits = 8),
ids AS (SELECT DISTINCT CAST(conv_id AS BIGINT) AS c FROM conversations WHERE conv_id IS NOT NULL),
digits AS (SELECT c, 0 AS i, 4294967295 AS v FROM ids
  UNION ALL SELECT c, i + 1, xor(digits.v >> 8, bytes.v) FROM digits JOIN bytes ON byte = xor(digits.v & 255, ascii(substr(CAST(c AS VARCHAR), i + 1, 1)))
  WHERE i < length(CAST(c AS VARCHAR))),
heads AS (SELECT c, xor(v, 4294967295) % 4 AS h FROM digits WHERE i = length(CAST(c AS VARCHAR))),
t AS (SELECT CAST(conv_id AS BIGINT) AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i FROM conversations WHERE conv_id IS NOT NULL),
kinds AS (SELECT role, text, row_number() OVER () AS k, len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words
  FROM (SELECT DISTINCT role, text FROM t)),
coded AS (SELECT c, i, k FROM t JOIN kinds USING (role, text)),
parts AS (SELECT heads.c, 0 AS part, i, k FROM heads JOIN coded ON coded.c = heads.c - heads.c % 20 AND i <= h
  UNION ALL SELECT heads.c, 1, i, k FROM heads JOIN coded ON coded.c = heads.c AND i > h),
placed AS (SELECT c, k, row_number() OVER (PARTITION BY c ORDER BY part, i) AS d FROM parts),
begun AS (SELECT c, d, k, string_agg(CAST(k AS VARCHAR), '/') OVER (PARTITION BY c ORDER BY d) || '/' AS p FROM placed
  UNION ALL SELECT c, 0, NULL, '' FROM ids),
size AS (SELECT c, max(d) AS n FROM begun GROUP BY c),
node AS (SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, any_value(k) AS k,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = n), '') AS ends
  FROM begun JOIN size USING (c) GROUP BY p, d),
child AS (SELECT a.p, count(b.p) AS n_children FROM node a LEFT JOIN node b ON b.d = a.d + 1 AND starts_with(b.p, a.p) GROUP BY a.p),
own AS (SELECT node.*, n_children, (n_convs - 1) * coalesce(words, 0) AS saved FROM node JOIN child USING (p) LEFT JOIN kinds USING (k)),
below AS (SELECT a.p, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum(b.saved) AS saved_tokens FROM own a JOIN own b ON starts_with(b.p, a.p) GROUP BY a.p)
SELECT own.conv_id, CAST(own.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(own.ends) AS ends_sha256
FROM own JOIN below USING (p) LEFT JOIN node up ON own.d > 0 AND up.p = regexp_replace(own.p, '[0-9]+/$', '')
"""
