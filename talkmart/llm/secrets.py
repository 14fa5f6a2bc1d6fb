"""Secret scans: patterns propose candidates, a random forest removes the false positives.

The forest looks at a candidate's length, the changes between its characters, how much of it common words
cover, the document's path and the words around it. It is trained on labelled findings: a table of texts with
a marked candidate and whether it is a secret. Extraction, features and scoring are DataFrame expressions.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmart.functions.once import computed_once
from talkmart.llm.staging import stage
from talkmart.llm.text import free_name, matches, row_key

#: What is assigned to something named like a secret, to its end, or else runs of key characters with a digit. ``=``
#: parts names from values and belongs to a run only as padding at its end. Possessive, so linear; the short look
#: behind for the sign comes before the long one for the name.
CANDIDATE = (
    r"(?<=[:=][\x20\t]{0,4}[\x22']?)(?![:=])"
    r"(?<=(?i:token|secret|passw|passphrase|pwd|api.?key|auth(?!ors?\b)|bearer|credential|private.?key|access.?key)"
    r"[A-Za-z0-9_-]{0,20}[\x22']?[\x20\t]{0,4}[:=]{1,2}[\x20\t]{0,4}[\x22']?)[^\s\x22'<>]{8,}+"
    r"|(?<![A-Za-z0-9+/_.-])(?=[A-Za-z+/_.-]{0,64}[0-9])[A-Za-z0-9+/_.-]{16,}+(?:={1,2}+(?![A-Za-z0-9+/_.-]))?"
)
GATE = r"[A-Za-z0-9+/_.-]{16}|[:=][\x20\t]{0,4}[\x22']?[^\s\x22'<>]{8}"
NEARBY = 40
SCORE = 0.5
#: Common words that cover candidates, counted in the corpus; findings the forest is trained on; its size.
WORDS = 300
FINDINGS = 6_000
TREES, DEPTH, SEED = 30, 8, 11

_NAMES = r"(?i)(token|secret|passw|pwd|api.?key|auth|bearer|credential|private|access.?key)"
_OTHERS = r"(?i)(commit|checksum|sha-?\d*|md5|digest|uuid|guid|version|build|isbn|order|invoice|hash)"
FEATURES = (
    "length",
    "digits",
    "uppers",
    "others",
    "kinds_change",
    "case_change",
    "vowels_change",
    "distinct",
    "is_hex",
    "is_uuid",
    "is_number",
    "covered",
    "named",
    "named_else",
    "assigned",
    "quoted",
    "is_test_path",
    "path_depth",
)


def common_words(docs: DataFrame, many: int = WORDS) -> list[str]:
    """The words of three to eight ASCII letters that stand in most documents, at most ``many``."""
    letters = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(?<![a-z])[a-z]{3,8}(?![a-z])"), F.lit(0))
    words = docs.select(F.explode(F.array_distinct(letters)).alias("word"))
    rows = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(many).collect()
    return sorted((r["word"] for r in rows), key=lambda w: (-len(w), w))


def _share(raw: Column, pattern: str) -> Column:
    return F.regexp_count(raw, F.lit(pattern)) / F.greatest(F.length(raw), F.lit(1))


def with_features(rows: DataFrame, words: list[str]) -> DataFrame:
    """``rows`` (raw, before, after, path) with a column per feature."""
    raw, before = F.col("raw"), F.col("before")
    covered = F.lit(0.0)
    if words:
        left = F.regexp_replace(F.lower(raw), "|".join(words), "")
        covered = 1 - F.length(left) / F.greatest(F.length(raw), F.lit(1))
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    path = F.coalesce("path", F.lit(""))
    values = {
        "length": F.log1p(F.length(raw)),
        "digits": _share(raw, "[0-9]"),
        "uppers": _share(raw, "[A-Z]"),
        "others": _share(raw, "[^A-Za-z0-9]"),
        "kinds_change": _share(raw, r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"),
        "case_change": _share(raw, r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "vowels_change": _share(raw, r"(?i)(?<=[aeiou])(?=[b-df-hj-np-tv-z])|(?<=[b-df-hj-np-tv-z])(?=[aeiou])"),
        "distinct": F.size(F.array_distinct(F.split(raw, ""))) / F.greatest(F.length(raw), F.lit(1)),
        "is_hex": yes(raw.rlike("^[0-9a-fA-F]+$")),
        "is_uuid": yes(raw.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")),
        "is_number": yes(raw.rlike("^[0-9.+-]+$")),
        "covered": covered,
        "named": yes(before.rlike(_NAMES)),
        "named_else": yes(before.rlike(_OTHERS)),
        "assigned": yes(before.rlike(r"[:=]\s*[\x22']?$")),
        "quoted": yes(before.rlike(r"[\x22']$") & F.col("after").rlike(r"^[\x22']")),
        "is_test_path": yes(path.rlike(r"(?i)(test|example|sample|fixture|mock|docs?/)")),
        "path_depth": F.size(F.split(path, "/")),
    }
    return computed_once(rows, rows.columns, {name: values[name].cast("double") for name in FEATURES})


def _candidates(rows: DataFrame, *keep: str) -> DataFrame:
    """A row per candidate of ``rows`` (keep, text): the columns to keep, start, end, raw, before and after."""
    text = F.col("text")
    rows = computed_once(rows, [*keep, "text"], {"found": matches(text, CANDIDATE, GATE)})
    first = lambda x: F.greatest(F.lit(1), x["start"] + 1 - NEARBY)
    around = F.transform(
        "found",
        lambda x: F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["raw"].alias("raw"),
            F.substring(text, first(x), x["start"] + 1 - first(x)).alias("before"),
            F.substring(text, x["end"] + 1, F.lit(NEARBY)).alias("after"),
        ),
    )
    return rows.filter(F.size("found") > 0).select(*keep, F.inline(around))


def labelled_findings(spark: SparkSession, rows: int = FINDINGS) -> DataFrame:
    """(raw, before, after, path, label): findings as reviewers label them, made by rule from hashes of row numbers.

    Whole texts are made and cut as those of a corpus are. Secrets: random keys of usual shapes and passwords that
    something is given or called, quoted or not. Others: checksums, identifiers, numbers, versions, paths,
    placeholders and compound words, some of them quoted or assigned, also to names of secrets.
    """
    n = F.col("id")
    pick = lambda salt, *options: F.element_at(F.array(*map(F.lit, options)), (F.pmod(F.xxhash64(n, F.lit(salt)), F.lit(len(options))) + 1).cast("int"))
    hexes = F.sha2(n.cast("string"), 256)
    keys = F.translate(F.base64(F.unhex(F.sha2(F.concat(n.cast("string"), F.lit("k")), 256))), "=", "")
    shapes = F.pmod(F.xxhash64(n, F.lit("shape")), F.lit(10))
    size = (F.pmod(F.xxhash64(n, F.lit("size")), F.lit(25)) + 16).cast("int")
    compound = F.concat(pick("a", "order", "chapter", "station", "freight", "number"), pick("b", "-", "_", "/", "."), pick("c", "summary", "overview", "internal", "standard"), n % 90)
    secret = F.pmod(F.xxhash64(n, F.lit("label")), F.lit(2)) == 1
    key = (
        F.when(shapes < 3, F.substring(hexes, 1, 40))
        .when(shapes < 4, F.substring(hexes, 1, 32))
        .when(shapes < 5, hexes)
        .when(shapes < 6, F.concat(F.lit("AKIA"), F.upper(F.substring(keys, 1, 16))))
        .when(shapes < 7, F.concat(F.substring(keys, F.lit(1), size - 6), pick("sign", "!", "#", "$", "%", "&"), F.substring(keys, F.lit(41), F.pmod(n, F.lit(4)).cast("int"))))
        .otherwise(F.substring(keys, F.lit(1), size))
    )
    uuid = F.concat_ws("-", *(F.substring(hexes, a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    other = (
        F.when(shapes < 2, F.substring(hexes, 1, 40))
        .when(shapes < 3, uuid)
        .when(shapes < 5, F.lpad(F.abs(F.xxhash64(n)).cast("string"), 18, "4"))
        .when(shapes < 8, compound)
        .when(shapes < 9, F.concat(F.lit("example-key-000000"), n % 10))
        .otherwise(F.concat(F.lit("v2."), n % 30, F.lit(".0-build.2024"), n % 100))
    )
    called = pick("name", "token = ", "api_key: ", "secret=", "Authorization: Bearer ", "password = ", "access_key = ", "private key: ", "auth_token=", "token=", "api_key=", "AWS_SECRET_ACCESS_KEY=", "password=", "password: ", "DB_PASSWORD=")
    word = pick("word", "required", "string", "disabled", "configured", "placeholder", "changeable", "parameter", "environment")
    named = F.pmod(F.xxhash64(n, F.lit("named")), F.lit(4)) == 0
    described = F.element_at(
        F.array(compound, F.concat(word, pick("join", "_", "-", "."), pick("word2", "value", "field", "option")), word, F.concat(F.lit("YOUR_"), F.upper(word), F.lit("_HERE"))),
        (F.pmod(F.xxhash64(n, F.lit("described")), F.lit(4)) + 1).cast("int"),
    )
    around = F.when(
        shapes < 2, pick("sum", "commit ", "sha1 checksum ", "digest: ", "md5 = ")
    ).otherwise(pick("text", "the order ", "see ", "build = ", "uuid: ", "version ", "number ", "ident ", "id = "))
    quote = F.when(F.pmod(F.xxhash64(n, F.lit("quote")), F.lit(3)) > 0, F.lit('"')).otherwise("")
    path = F.when(secret, pick("path", "src0", "config/app.env", "deploy/main.yml")).otherwise(pick("path", "src0", "docs/readme.md", "tests/data.txt"))
    lead = F.concat(pick("lead", "", "and then ", "of the "), F.when(secret | named, called).otherwise(around), quote)
    made = spark.range(rows).select(
        F.when(secret, key).when(named, described).otherwise(other).alias("value"),
        lead.alias("lead"),
        F.concat(quote, pick("tail", "", " and", "\n")).alias("tail"),
        path.alias("path"),
        secret.alias("secret"),
    )
    texts = made.select("value", "path", "secret", F.concat("lead", "value", "tail").alias("text"))
    label = (F.col("secret") & F.col("raw").contains(F.col("value"))).cast("double").alias("label")
    return _candidates(texts, "value", "path", "secret").select("raw", "before", "after", "path", label)


def train(findings: DataFrame, words: list[str]) -> RandomForestClassificationModel:
    """A forest on labelled findings (raw, before, after, path, label), a bounded table."""
    rows = stage(with_features(findings, words).select("label", *FEATURES), "findings")
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label").fit(table)


def findings(docs: DataFrame, model: RandomForestClassificationModel, words: list[str], score: float = SCORE) -> DataFrame:
    """One row per candidate: doc_id, row_key, start, end, raw, score, is_secret.

    ``docs`` has doc_id, text and, as the path, source (NULL counts as empty). Texts without candidates, NULL and
    empty ones give no rows. Rows with the same id and text give the same findings, each row its own.
    """
    path = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    texts = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id"), texts.alias("text"), row_key().alias("row_key"), path.alias("path"))
    rows = _candidates(rows, "doc_id", "row_key", "path")
    rows = with_features(rows, words)
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(rows)
    scored = model.transform(table).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return scored.select("doc_id", "row_key", "start", "end", "raw", "score", (F.col("score") >= score).alias("is_secret"))


def redact(docs: DataFrame, found: DataFrame, mark: str = "<secret>") -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced by ``mark`` and n_chars, where there is one, kept in step."""
    spans = F.sort_array(F.collect_set(F.struct("start", "end")))
    cuts = found.filter("is_secret").groupBy("row_key").agg(spans.alias("cuts"))
    key, name = free_name(docs, "cut_key"), free_name(docs, "cut_spans")
    cuts = cuts.select(F.col("row_key").alias(key), F.col("cuts").alias(name))
    text, spans = F.coalesce(F.col("text"), F.lit("")), F.col(name)
    start = lambda i: F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))
    end = lambda i: F.coalesce(F.get(spans, i)["start"], F.length(text))
    pieces = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.substring(text, start(i) + 1, end(i) - start(i)))
    clean = F.when(spans.isNull(), F.col("text")).otherwise(F.array_join(pieces, mark))
    # A column of its own first: inside a lambda, "text" would mean the new column of the same select.
    new = free_name(docs, "clean_text")
    joined = docs.join(cuts, row_key() == F.col(key), "left").withColumn(new, clean)
    n_chars = F.when(spans.isNull(), F.col("n_chars")).otherwise(F.length(new)) if "n_chars" in docs.columns else None
    changed = {"text": F.col(new), "n_chars": n_chars}
    return joined.select(*(changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else docs[c] for c in docs.columns))


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``findings`` of a corpus, with its own common words and a forest trained on ``labelled`` findings."""
    words = common_words(docs)
    model = train(labelled if labelled is not None else labelled_findings(docs.sparkSession), words)
    return findings(docs, model, words)
