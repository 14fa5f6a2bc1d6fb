"""Operators that decide on each row: personal data, licenses, quality, contamination."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from talkmart.llm import decontamination, licenses, pii, quality
from talkmart.llm.queries import QUERIES
from tests.llm import plain

FOLDER = "/root/testdata/sf0.001"


def documents(spark):
    rows = [(i, text) for i, text in enumerate(plain.ODD)] + [(3, "one"), (None, "one"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("doc_id", F.lit(1).alias("words"), "text", F.lit("x").alias("row_key"), F.lit(2).alias("spans")), rows


def given(table, *columns):
    return list(pd.read_parquet(f"{FOLDER}/{table}.parquet")[list(columns)].itertuples(index=False, name=None))


def same(rows, wanted):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in rows), key=key) == sorted((tuple(r) for r in wanted), key=key)


def test_contamination_of_the_whole_table(spark):
    same(QUERIES["op4_decontamination"](spark, FOLDER).collect(), plain.contamination(given("documents", "doc_id", "text"), given("benchmark", "item_id", "text")))


def test_contamination_of_odd_rows(spark):
    docs, rows = documents(spark)
    long = " ".join(f"w{i}" for i in range(40))
    extra = [(50, long), (51, "x " + " ".join(f"w{i}" for i in range(5, 18)) + " y"), (52, long + " " + long), (53, " ".join(f"w{i}" for i in range(5, 17)))]
    items = [(1, long), (2, "one"), (3, "x y"), (4, None), (5, ""), (1, long), (10, "W5 w6, w7 w8 w9 w10 w11"), (11, "general public license cc")]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.contamination(docs, bench)
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    same(out.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated").collect(), plain.contamination(rows + extra, items))
    kept = decontamination.drop_contaminated(docs, bench)
    bad = {r[0] for r in plain.contamination(rows + extra, items) if r[-1]}
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted(i for i, _ in rows + extra if i is not None and i not in bad)


@pytest.mark.parametrize("empty", ["docs", "bench"])
def test_contamination_with_an_empty_table(spark, empty):
    docs = spark.createDataFrame([] if empty == "docs" else [(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([] if empty == "bench" else [(1, "a b c")], "item_id long, text string")
    out = decontamination.contamination(docs, bench).collect()
    assert [(r.doc_id, r.contaminated) for r in out] == ([] if empty == "docs" else [(1, False)])


def base_rows(rows):
    order = ["email", "ip", "card", "phone"]
    for doc_id, text in rows:
        spans = plain.base_spans(text)
        yield (doc_id, *(sum(k == x[0] for x in spans) for k in order), plain.sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans)))


def test_personal_data(spark):
    docs, rows = documents(spark)
    out = pii.personal_data(docs)
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind))
    digest = F.sha2(pii.marks(pii.base_only(F.col("spans"))), 256)
    same(out.select("doc_id", *map(number, ("email", "ip", "card", "phone")), digest).collect(), base_rows(rows))
    assert pii.personal_data(docs.limit(0)).collect() == []
    whole = QUERIES["op5_pii"](spark, FOLDER).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    same(whole.collect(), base_rows(given("documents", "doc_id", "text")))


def test_personal_data_of_other_kinds(spark):
    texts = ["iban DE89 3704 0044 0532 0130 00.", "DE88370400440532013000", "my ssn: 219-09-9999", "219-09-9999", "call (415) 555-0132", "(415) 555-0132"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [x.raw for x in r.spans] for r in pii.personal_data(docs).collect()}
    assert found == {0: ["DE89 3704 0044 0532 0130 00"], 1: [], 2: ["219-09-9999"], 3: [], 4: ["(415) 555-0132"], 5: []}


def test_license_phrases(spark):
    docs, rows = documents(spark)
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    same(licenses.licenses(docs).select(*columns).collect(), [(i, *plain.phrases(t)) for i, t in rows])
    whole = QUERIES["op6_licenses"](spark, FOLDER).select(*columns)
    same(whole.collect(), [(i, *plain.phrases(t)) for i, t in given("documents", "doc_id", "text")])
    assert licenses.licenses(docs.limit(0)).collect() == []


def test_license_spans(spark):
    mit = licenses.NOTICES[2][1]
    changed = mit.replace("without limitation", "no limits at all").replace("free of charge", "free of any charge")
    texts = [f"foo bar {mit} end", f"x {changed} y", "permission is hereby granted to nobody", f"{mit} gap {mit}", "Released under the MIT License."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in licenses.licenses(docs).collect()}
    assert [out[i].labels for i in range(5)] == ["mit", "mit", "", "mit", "mit"]
    assert out[0].score == 1.0 and 0.6 < out[1].score < 1.0 and out[2].score == 0.0
    keyed = licenses.keyed(docs)
    spans = licenses.license_spans(keyed).join(keyed, "row_key").filter("doc_id = 3").collect()
    n = len(mit.split())
    assert sorted((r["first"], r["last"]) for r in spans) == [(0, n - 1), (n + 1, 2 * n)]


#: Texts and the labels that each must get, near misses and wording of several licenses among them.
LICENSE_TEXTS = [
    ("The film was released under the title Dawn.", ""),
    ("Goods are licensed under the terms of trade.", ""),
    ("It is licensed under the Apache License, Version 2.0 (the License).", "apache"),
    ("Licensed under the Apache License.", "apache"),
    ("Licensed under the GNU General Public License, version 3.", "gpl"),
    ("Licensed under the GNU Lesser General Public License.", "gpl,lgpl"),
    ("This is released under the MIT License.", "mit"),
    ("Dual: licensed under the MIT License or licensed under the Apache License, version 2.0", "apache,mit"),
    ("Licensed under CC-BY-NC 4.0", "cc-by,cc-by-nc"),
    ("Licensed under CC BY-SA 4.0", "cc-by,cc-by-sa"),
    ("Licensed under CC BY-NC-SA 4.0", "cc-by,cc-by-nc-sa"),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("You may redistribute it in source and binary forms, with or without changes", ""),
]


def test_license_labels_of_near_misses_and_neighbours(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LICENSE_TEXTS)], "doc_id long, text string")
    out = {r.doc_id: r.labels for r in licenses.licenses(docs).collect()}
    assert [out[i] for i in range(len(LICENSE_TEXTS))] == [labels for _, labels in LICENSE_TEXTS]


def test_no_mit_label_on_documents_that_do_not_name_it(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = licenses.licenses(docs).select("doc_id", "labels").join(docs.select("doc_id", "text"), "doc_id").toPandas()
    assert len(out) == docs.count()
    named = out.text.fillna("").str.lower().str.contains(r"\bmit\b|hereby granted")
    mit = out.labels.str.split(",").map(lambda x: "mit" in x)
    assert not (mit & ~named).any()


def test_quality_counts(spark):
    docs, rows = documents(spark)
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    wanted = lambda rows: [(i, *s, s[0] < 50 or 100 * s[4] > 50 * s[0]) for i, t in rows for s in [plain.shape(t)]]
    trusted = spark.createDataFrame([(6,), (None,), (99,)], "doc_id long")
    same(quality.quality(docs, trusted).select(*columns).collect(), wanted(rows))
    whole = QUERIES["op10_quality"](spark, FOLDER)
    same(whole.select(*columns).collect(), wanted(given("documents", "doc_id", "text")))
    assert quality.quality(docs.limit(0), trusted).collect() == []


def test_quality_scores(spark):
    import math

    good, raw = "alpha beta gamma delta", "spam ham eggs"
    docs = spark.createDataFrame([(1, good), (2, raw), (3, good + " " + raw), (4, None)], "doc_id long, text string")
    out = {r.doc_id: r.score for r in quality.quality(docs, docs.filter("doc_id = 1")).collect()}
    assert out[1] > out[3] > out[2] and out[4] is None
    # by hand: 7 n-grams of the target (4 words, 3 pairs), 7 + 5 + 13 in the corpus, no two in one bucket
    size = quality.BUCKETS
    weight = lambda t, c: round(math.log((t + 1) / (7 + size)) - math.log((c + 1) / (25 + size)), 6)
    assert out[1] == pytest.approx(weight(1, 2), abs=1e-6) and out[2] == pytest.approx(weight(0, 2), abs=1e-6)
    flat = quality.quality(docs, docs.limit(0)).filter("doc_id < 4").collect()
    assert {r.score for r in flat} == {0.0}


def test_quality_of_a_very_long_text(spark):
    text = " ".join(f"w{i % 5000}" for i in range(30_000))
    docs = spark.createDataFrame([(1, text), (2, "other words")], "doc_id long, text string")
    out = {r.doc_id: r for r in quality.quality(docs, docs.filter("doc_id = 1").select("doc_id")).collect()}
    assert (out[1].n_words, out[1].n_repeat_words, out[1].base_failed) == (30_000, 30_000, True)
    assert out[1].score > 0 > out[2].score


@pytest.mark.parametrize("many", [120_000, 210_000])
def test_quality_counts_every_trusted_document(spark, many):
    """Where all documents with an id are trusted, target and corpus differ by the rows without an id only."""
    n = F.col("id")
    docs = spark.range(many + 100).select(F.when(n < many, n).alias("doc_id"), F.concat_ws(" ", F.lit("w"), n % 977).alias("text"))
    trusted = docs.filter("doc_id is not null").select("doc_id")
    assert {r.weight for r in quality.log_ratios(trusted.join(docs, "doc_id"), trusted).collect()} == {0.0}
    ((target, every),) = quality._with_target(docs, trusted).agg(F.count("is_target"), F.count("text")).collect()
    assert (target, every) == (many, many + 100)
