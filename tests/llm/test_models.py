"""Operators with trained models: languages, main text, toxicity, secrets."""

import html
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from talkmart.llm import extraction, language, secrets, toxicity
from talkmart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return language.fit_text_model(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def fused(rows, model):
    """The posterior by hand, from (host, domain, suffix, declared, text)."""
    size = len(model.languages)
    start = np.log(np.append(np.full(size, (1 - language.UNKNOWN_SHARE) / size), language.UNKNOWN_SHARE))
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    scores = [sum((language.TEMPER * model.log_shares[:, c] for c in language._cells(t or "")), np.zeros(size + 1)) for *_, t in rows]
    own = [np.round(soft(s + start) * 1e6) / 1e6 for s in scores]
    tags = [*model.languages, "other"]
    seen = np.full((size + 1, size + 1), 0.5)
    for (*_, declared, _), p in zip(rows, own):
        if declared:
            seen[tags.index(declared if declared in tags else "other")] += p
    reliability = np.log(seen / seen.sum(axis=0))
    base = (sum(own) + np.exp(start)) / (sum(own).sum() + 1)
    out = []
    for i, (host, domain, suffix, declared, _) in enumerate(rows):
        prior = base
        for level, name in ((2, suffix), (1, domain), (0, host)):
            counts = sum((p for j, (r, p) in enumerate(zip(rows, own)) if j != i and r[level:3] == rows[i][level:3]), np.zeros(size + 1))
            prior = (counts + language.CONCENTRATION * prior) / (counts.sum() + language.CONCENTRATION)
        evidence = scores[i] + np.log(np.maximum(prior, 1e-12))
        if declared:
            evidence = evidence + reliability[tags.index(declared if declared in tags else "other")]
        out.append(np.round(soft(evidence), 5).max())
    return out


def test_evidence_is_fused_as_by_hand(spark, model):
    rng = random.Random(4)
    texts = [None, "", "the of and", "der die das und", "le la de que", "el la que de", "12345 ###", "of"]
    rows = [(f"h{rng.randint(0, 4)}.d{rng.randint(0, 1)}.org", None, "org", rng.choice([None, "en", "de", "xx"]), rng.choice(texts)) for _ in range(60)]
    rows = [(h, h.split(".", 1)[1], s, d, t) for h, _, s, d, t in rows]
    df = spark.createDataFrame([(i, t, d, h, m, s) for i, (h, m, s, d, t) in enumerate(rows)], "key int, text string, declared string, host string, domain string, suffix string")
    got = [r.probability for r in language.identify(df, model).orderBy("key").collect()]
    assert got == pytest.approx(fused(rows, model), abs=2e-5)
    assert language.identify(df.limit(0), model).collect() == []


def test_language_of_held_out_documents(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id >= 1000 and doc_id < 2500")
    rows = docs.select(F.struct("doc_id", "lang").alias("key"), "text", *(F.lit(None).cast("string").alias(c) for c in ("declared", "host", "domain", "suffix")))
    out = language.identify(rows, model).collect()
    assert len(out) == docs.count()
    assert sum(r.lang == r.key.lang for r in out) >= 0.97 * len(out)


def test_languages_of_odd_pages(spark, model):
    rows = [(1, "http://a.example.com/x", None), (1, "http://a.example.com/x", None), (None, None, ""), (3, "nonsense", "<html lang='DE-at'><p>der die und</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("lang", F.lit("x"))
    out = {(r.key.page_id, r.key.url): (r.declared, r.lang, r.accepted) for r in language.identify_pages(pages, model).collect()}
    assert language.identify_pages(pages, model).count() == 4
    assert out[(3, "nonsense")] == ("de", "de", True)
    docs = spark.createDataFrame([(1, "the of and this that with", "xx", "s", 5), (2, "#### 123", None, None, 1), (None, "der die das und nicht", "de", "s", 2)], "doc_id long, text string, lang string, source string, language_key int")
    kept = language.known_language(docs, model)
    assert kept.columns == docs.columns and {(r.doc_id, r.lang) for r in kept.collect()} >= {(1, "en"), (None, "de")}


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inner))).split())


def test_main_text_of_the_whole_table(spark):
    pages = pd.read_parquet(f"{FOLDER}/pages.parquet")
    got = {r.page_id: r for r in QUERIES["op3_html_extraction"](spark, FOLDER).collect()}
    assert len(got) == len(pages)
    assert all(got[r.page_id].text == article(r.html) and got[r.page_id].n_chars == len(article(r.html)) for r in pages.itertuples())


@pytest.fixture(scope="module")
def field(spark):
    return extraction.train(spark.read.parquet(f"{FOLDER}/pages.parquet"))


def test_main_text_in_other_layouts(spark, field):
    pages = pd.read_parquet("/root/testdata/sf0.1/pages.parquet").html[300:600]
    rows = []
    for page in pages:
        own = extraction.blocks(page)
        labels = extraction.marked(own)
        if labels:
            main = [b.text for b, y in zip(own, labels) if y][:40]
            other = [b.text for b, y in zip(own, labels) if not y] + main[1:]
            rows.append((len(rows), *extraction.layout(main, other, random.Random(zlib.crc32(page.encode()) + 1))))
    df = spark.createDataFrame([(i, "u", p) for i, p, _ in rows], "page_id int, url string, html string")
    got = {r.page_id: r.text for r in extraction.extract(df, field).collect()}
    assert sum(got[i] == text for i, _, text in rows) >= 0.95 * len(rows)


def test_odd_pages(spark, field):
    pages = [
        None,
        "",
        "plain words, no markup at all, but long enough to be an article of its own.",
        "<article><p>A &lt;b&gt; &amp;amp; c &#233;&nbsp;x<br>y <b>bo</b>ld 3 < 5</p><script>var a='</p>';</script><!-- no --><p>Second line.</p>",
        "<article>" + "<div>" * 3000 + "Deep text of the article." + "</div>" * 3000 + "</article><footer>foot</footer>",
        "<nav><a href=x>Menu</a></nav><",
        "<article><p>" + "Long sentence of words. " * 20000 + "</p></article>",
    ]
    df = spark.createDataFrame([(i, "u", p, 1) for i, p in enumerate(pages)] + [(None, None, pages[3], 1), (3, "u", pages[3], 1)], "page_id long, url string, html string, text int")
    got = extraction.extract(df, field).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == 9 and texts[0] == texts[1] == "" and all(r.n_chars == len(r.text) for r in got)
    assert texts[3] == texts[None] == "A <b> &amp; c é x y bold 3 < 5 Second line."
    assert texts[4] == "Deep text of the article." and texts[6] == ("Long sentence of words. " * 20000).strip()
    assert extraction.extract(df.limit(0), field).collect() == []


def test_self_closed_svg_hides_nothing():
    page = '<body><p>One <svg class="icon" href="#x" /> two.</p><svg/><p>Three.</p><svg><text>no</text><svg/></svg><p>Four.</p></body>'
    assert [b.text for b in extraction.blocks(page)] == ["One two.", "Three.", "Four."]


def test_viterbi_and_likelihood(field):
    """The decoded path is the best of all paths, and training raises the likelihood of its pages."""
    rng = random.Random(2)
    for _ in range(20):
        cells = [[rng.randrange(extraction.CELLS) for _ in range(4)] for _ in range(7)]
        score = lambda path: sum(field.weights[y, c].sum() for y, c in zip(path, cells)) + sum(field.steps[a, b] for a, b in zip(path, path[1:]))
        paths = [[n >> i & 1 for i in range(7)] for n in range(128)]
        assert score(field.decode(cells)) == pytest.approx(max(map(score, paths)))
    toy = [([[1], [2], [1]], [0, 1, 0]), ([[2], [2]], [1, 1])] * 5
    learned = extraction.fit(toy)
    assert learned.decode([[1], [2], [2], [1]]) == [0, 1, 1, 0] and extraction.fit([]).decode([[1]]) == [0]


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    out = QUERIES["op7_toxicity"](spark, folder).toPandas()
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    assert sorted(out.doc_id) == sorted(docs.doc_id)
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(out.doc_id, out.held_out))
    assert ((out.score >= 0.3) == (out.predicted == 1)).all() and out.score.between(0, 1).all()
    held = out[out.held_out].merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id")
    right = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert right >= 0.85 * (held.toxic == 1).sum() and right >= 0.95 * (held.predicted == 1).sum()


def test_toxicity_does_not_read_held_out_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.toxicity(docs, x).collect())) for x in (labels, other))
    assert a == b


def test_toxicity_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (3, "you idiot moron"), (None, "plain words of no harm"), (5, "idiot " * 70000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, none).collect()
    by = {r.doc_id: r.score for r in got}
    assert len(got) == 6 and by[3] > by[None] and by[5] > by[1] == by[2]
    assert toxicity.toxicity(docs.limit(0), none).collect() == []


def test_label_model_finds_what_voters_are_worth():
    rng = np.random.default_rng(3)
    toxic = rng.random(20000) < 0.2
    rates = np.array([(0.6, 0.01), (0.5, 0.02), (0.4, 0.05), (0.1, 0.06)])
    votes = rng.random((20000, 4)) < np.where(toxic[:, None], rates[:, 0], rates[:, 1])
    full = toxicity.with_quiet(votes)
    table, n = np.unique(full, axis=0, return_counts=True)
    model = toxicity.fit_label_model(table, n.astype(float), full[:8000], toxic[:8000])
    wrong = ((model.posterior(full) >= 0.5) != toxic).mean()
    worth = model.on_toxic / model.on_clean
    assert wrong < 0.15 and worth[0] > worth[2] > worth[3] and abs(model.share - 0.2) < 0.08


def test_secrets_of_held_out_findings(spark):
    words = ["the", "and", "station", "number", "order"]
    every = secrets.labelled_findings(spark, 3000)
    part = F.pmod(F.xxhash64("raw", "before"), F.lit(3))
    forest = secrets.train(every.filter(part > 0), words)
    from pyspark.ml.feature import VectorAssembler

    rows = secrets.with_features(every.filter(part == 0), words)
    out = forest.transform(VectorAssembler(inputCols=list(secrets.FEATURES), outputCol="features").transform(rows))
    assert out.filter("prediction = label").count() >= 0.97 * out.count()


def test_secrets_and_redaction(spark):
    key, sha = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "a94a8fe5ccb19ba61c4c0873d391e987982fbbd3"
    texts = [f'x token = "{key}" and api_key: {key[::-1]}', f"see commit {sha} of today", None, "", "no candidates", "é\U0001f600 " * 30 + f'token = "{key}" end', "9" * 30000, f'token = "{key}"']
    rows = [(i, t, "src", len(t or "")) for i, t in enumerate(texts)] + [(7, texts[7], "src", 3), (None, texts[7], None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").withColumn("raw", F.lit(1)).withColumn("cuts", F.lit(2))
    found = secrets.scan(docs)
    got = [(r.doc_id, r.raw) for r in found.filter("is_secret").collect()]
    assert sorted(got, key=str) == sorted([(0, key), (0, key[::-1]), (5, key), (7, key), (7, key), (None, key)], key=str)
    for r in found.collect():
        assert (texts[7 if r.doc_id is None else r.doc_id])[r.start : r.end] == r.raw
    clean = secrets.redact(docs, found)
    assert clean.columns == docs.columns
    by = {r.doc_id: r for r in clean.collect()}
    assert clean.count() == len(rows) and by[2].text is None
    assert by[0].text == 'x token = "<secret>" and api_key: <secret>' and by[0].n_chars == len(by[0].text)
    assert by[1].text == texts[1] and by[5].text == "é\U0001f600 " * 30 + 'token = "<secret>" end'
    assert secrets.scan(docs.limit(0)).collect() == []


def test_assigned_secrets_are_found_whole(spark):
    key, plain = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", "".join("kQzXwVbNmRtPLs"[i * i % 14] + "qWxZ"[i % 4] for i in range(40))
    assigned = {
        f"token={key}": key,
        f"export api_key={key} ok": key,
        "AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/K7MDENG+bPxRfiCYzz0q1Kd8Ta": "wJalrXUtnFEMI/K7MDENG+bPxRfiCYzz0q1Kd8Ta",
        "password=x9Kq27LmZt84RwPv": "x9Kq27LmZt84RwPv",
        "password: Abcdef1234567890!rest end": "Abcdef1234567890!rest",
        f"password = {key * 5} end": key * 5,
        f"token: {plain}": plain,
        f'{{"api_key": "{key}"}}': key,
        f"secret=dGhpcyBpcyBhIGtleSBvZiAzMg{key[:5]}== end": f"dGhpcyBpcyBhIGtleSBvZiAzMg{key[:5]}==",
    }
    others = ["password: required_value", "token=placeholder", "the author: Shakespeare wrote", "api_key=YOUR_PARAMETER_HERE", "secret: configured.option"]
    texts = [*assigned, *others]
    docs = spark.createDataFrame([(i, t, "src") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    found = secrets.scan(docs).filter("is_secret")
    got = {(r.doc_id, r.raw) for r in found.collect()}
    assert got == set(enumerate(assigned.values()))
    clean = {r.doc_id: r.text for r in secrets.redact(docs, found).collect()}
    assert [clean[i] for i in range(len(texts))] == [t.replace(v, "<secret>") for t, v in assigned.items()] + others
