"""The pipeline's stages: each does what its operator says, and nothing else changes."""

import re

import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tests.llm import plain
from tests.llm.test_jaccard import brute
from tests.llm.test_packing import checked, wanted
from talkmart.llm.packing import Capacity

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, tables = docs.columns, [docs.toPandas()]
    for i, (_, step) in enumerate(pipeline.STAGES):
        step(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        tables.append(docs.toPandas())
        assert i == len(pipeline.STAGES) - 1 or docs.columns == columns
    raw, known, single, clean, safe, packed = tables
    both = raw.merge(known, on="doc_id")
    assert len(known) >= 0.98 * len(raw) and (both.lang_x == both.lang_y).mean() > 0.97
    rows = list(known[["doc_id", "text"]].itertuples(index=False, name=None))
    assert sorted(single.doc_id) == sorted({c for _, _, c in brute(rows)})
    items = list(pd.read_parquet(f"{FOLDER}/benchmark.parquet")[["item_id", "text"]].itertuples(index=False, name=None))
    verdicts = plain.contamination(list(single[["doc_id", "text"]].itertuples(index=False, name=None)), items)
    assert sorted(clean.doc_id) == sorted(v[0] for v in verdicts if not v[-1]) and any(v[-1] for v in verdicts)
    hidden = {r.doc_id: re.sub(r'(?<=token = ")[0-9a-f]{40}(?=")', "<secret>", r.text or "") for r in clean.itertuples()}
    assert {r.doc_id: r.text for r in safe.itertuples()} == hidden and "<secret>" in "".join(hidden.values())
    got = sorted(packed[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None))
    assert got == sorted(wanted(safe[["doc_id", "text"]].itertuples(index=False, name=None)))
    assert checked(packed.to_dict("records"), Capacity(2048)) <= -(-packed.length.sum() // 2048) + 1
    whole = entry.queries()["pipeline"](spark, FOLDER)
    assert whole.count() == len(packed) and whole.agg(F.sum("length")).first()[0] == packed.length.sum()


def test_odd_documents(spark):
    rows = [(i, t, "en", "s", None) for i, t in enumerate(plain.ODD)] + [(4, "one", "en", "s", 3), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, step in pipeline.STAGES:
        assert step(spark, docs.limit(0), FOLDER).count() == 0
        assert step(spark, docs, FOLDER).count() > 0
