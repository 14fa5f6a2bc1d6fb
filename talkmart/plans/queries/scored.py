"""Batches, prompts, replies, scores, retries."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkmart.functions.keys import stable_key
from talkmart.functions.text import clean_sentences
from talkmart.operators import quality, recovery, scoring
from talkmart.plans.queries import shapes as S
from talkmart.plans.queries.registry import cte, query, scratch_folder, sql_bucket, sql_clean, sql_key, stored, table, with_ctes
from talkmart.plans.score import score_with_memory

FILES = 16

cte(
    "turns",
    f"""SELECT * FROM (SELECT {sql_key('conv_id', 'turn')} AS sentence_uuid, {sql_clean('text')} AS sentence
      FROM conversations WHERE length(text) > 10 AND regexp_matches(text, '{S.LATIN}')) WHERE length(sentence) > 10""",
)
cte(
    "batched_turns",
    f"""SELECT *, CAST(rank // 20 AS INTEGER) AS batch_no, CAST(rank % 20 AS INTEGER) AS pos FROM
      (SELECT *, row_number() OVER (PARTITION BY file_no ORDER BY sentence_uuid) - 1 AS rank FROM
        (SELECT *, {sql_bucket('sentence_uuid', FILES)} AS file_no FROM turns))""",
    ("turns",),
)


def _turns(spark, folder):
    rows = table(spark, folder, "conversations").select(
        stable_key(F.col("conv_id"), F.col("turn")).alias("sentence_uuid"), F.col("text").alias("sentence")
    )
    return clean_sentences(rows, script=S.LATIN)


@query(
    "prompt_batches",
    with_ctes(
        """SELECT file_no, batch_no, CAST(count(*) AS INTEGER) AS n_items,
          string_agg((pos + 1) || '. ' || sentence, chr(10) ORDER BY pos) AS lines
        FROM batched_turns GROUP BY file_no, batch_no""",
        "batched_turns",
    ),
)
def _(spark, folder):
    batches = scoring.prompt_batches(scoring.assign_batches(_turns(spark, folder), "sentence_uuid", FILES))
    return batches.select("file_no", "batch_no", F.size("items").alias("n_items"), "lines")


_CUES = (
    scoring.Cue("tion", 0.1, "design"),
    scoring.Cue("ment", 0.2, "function"),
    scoring.Cue("aux", -0.3, "reliability"),
    scoring.Cue("ing", -0.4, "function"),
    scoring.Cue("sch", 0.4, "design"),
)
_SCORE = " + ".join(f"CASE WHEN contains(sentence, '{c.word}') THEN {round(c.weight * 100)} ELSE 0 END" for c in _CUES)
_FIRST = " ".join(f"WHEN contains(sentence, '{c.word}') THEN '{{}}'" for c in _CUES)


@query(
    "score_sentences",
    with_ctes(
        f"""SELECT sentence_uuid, CAST(greatest(0, least(100, 50 + {_SCORE})) AS DOUBLE) / 100 AS sentiment_score,
          CASE {_FIRST.format(*(c.category for c in _CUES))} ELSE 'other' END AS category,
          CASE {_FIRST.format(*(c.word for c in _CUES))} ELSE 'other' END AS keyword FROM turns""",
        "turns",
    ),
)
def _(spark, folder):
    parsed = scoring.score_sentences(_turns(spark, folder), scoring.CueScorer(_CUES, "other"), FILES)
    return scoring.classified(parsed)


cte(
    "document_lines",
    f"""SELECT * FROM (SELECT {sql_key('doc_id', 'pos')} AS sentence_uuid, {sql_clean('line')} AS sentence FROM
        (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
          generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
      WHERE length(line) > 10 AND regexp_matches(line, '{S.LATIN}')) WHERE length(sentence) > 10""",
)


@query(
    "score_memory",
    with_ctes(
        f"""SELECT sentence_uuid, CAST(greatest(0, least(100, 50 + {_SCORE})) AS DOUBLE) / 100 AS sentiment_score,
          CASE {_FIRST.format(*(c.category for c in _CUES))} ELSE 'other' END AS category,
          CASE {_FIRST.format(*(c.word for c in _CUES))} ELSE 'other' END AS keyword FROM document_lines""",
        "document_lines",
    ),
)
def _(spark, folder):
    """Lines of documents scored by distinct text, in two runs over one memory: the English documents, then all.

    The second run asks about the texts only that the first has not seen; all lines get the answer to their text.
    """
    lines = F.split("text", "\n")
    rows = table(spark, folder, "documents").select("doc_id", "lang", F.posexplode(lines).alias("pos", "sentence"))
    keyed = rows.select(stable_key(F.col("doc_id"), F.col("pos")).alias("sentence_uuid"), "sentence", "lang")
    # Written once: both runs read them twice, to find the distinct texts and to give them their answers.
    sentences = stored(clean_sentences(keyed, script=S.LATIN), "sentences")
    store, scorer = scratch_folder(spark, "scores"), scoring.CueScorer(_CUES, "other")
    score_with_memory(sentences.filter("lang = 'en'"), store, scorer)
    return scoring.classified(score_with_memory(sentences, store, scorer))


def _answered_documents(spark, folder):
    """Documents in batches with a stored reply: a toxic label spoils a line's score,
    and Spanish documents lack the category label."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    rows = docs.select(
        F.col("doc_id").cast("string").alias("sentence_uuid"),
        F.concat_ws(" ", "lang", "source", "n_chars").alias("sentence"),
        F.when(F.col("toxic") == 1, "n/a").otherwise(
            F.concat(F.lit("0."), F.coalesce("quality", F.lit(5)).cast("string"))
        ).alias("score"),
        F.when(F.col("lang") == "es", "").otherwise("주제: ").alias("label"),
        F.col("lang").alias("topic"),
        F.col("source").alias("word"),
    )
    batched = scoring.assign_batches(rows, "sentence_uuid", FILES)
    line = F.concat(
        (F.col("pos") + 1).cast("string"), F.lit(". 감성: ["), "score", F.lit("], "), "label", F.lit("["), "topic",
        F.lit("], 부주제: ["), "word", F.lit("]"),
    )
    item = F.struct("pos", F.col("sentence_uuid").alias("key"), F.col("sentence").alias("text"), line.alias("line"))
    grouped = batched.groupBy("file_no", "batch_no").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return grouped.withColumn("reply", F.array_join(F.transform("items", lambda i: i["line"]), "\n"))


cte(
    "answers",
    f"""SELECT *, CAST(rank // 20 AS INTEGER) AS batch_no, CAST(rank % 20 AS INTEGER) AS pos FROM
      (SELECT *, row_number() OVER (PARTITION BY file_no ORDER BY sentence_uuid) - 1 AS rank FROM
        (SELECT *, {sql_bucket('doc_id', FILES)} AS file_no, CAST(doc_id AS VARCHAR) AS sentence_uuid,
          lang || ' ' || source || ' ' || n_chars AS sentence,
          coalesce(toxic, 0) = 1 OR lang = 'es' AS bad,
          CASE WHEN coalesce(toxic, 0) = 0 THEN CAST(coalesce(quality, 5) AS DOUBLE) / 10 END AS sentiment_score
        FROM documents LEFT JOIN labels USING (doc_id)))""",
)


@query(
    "parse_replies",
    with_ctes(
        """SELECT file_no, batch_no, pos, sentence_uuid, sentence, sentiment_score,
          CASE WHEN lang <> 'es' THEN lang END AS category, source AS keyword, NOT bad AS ok FROM answers""",
        "answers",
    ),
)
def _(spark, folder):
    """Tolerant reading: only the sentence of a bad line fails."""
    return scoring.parse_replies(_answered_documents(spark, folder), strict=False)


@query(
    "reply_failures",
    with_ctes(
        """SELECT sentence_uuid, sentence FROM (SELECT *, bool_or(bad) OVER (PARTITION BY file_no, batch_no) AS broken
          FROM answers) WHERE broken""",
        "answers",
    ),
)
def _(spark, folder):
    """Strict reading: one bad line fails its whole batch."""
    return scoring.classified_failed(scoring.parse_replies(_answered_documents(spark, folder), strict=True))


@query(
    "classified_strict",
    with_ctes(
        """SELECT sentence_uuid, sentiment_score, lang AS category, source AS keyword
        FROM (SELECT *, bool_or(bad) OVER (PARTITION BY file_no, batch_no) AS broken FROM answers) WHERE NOT broken""",
        "answers",
    ),
)
def _(spark, folder):
    return scoring.classified(scoring.parse_replies(_answered_documents(spark, folder), strict=True))


@query(
    "scores_by_position",
    with_ctes(
        """SELECT doc_id, a.file_no, a.batch_no, a.pos, a.sentiment_score FROM answers a""",
        "answers",
    ),
)
def _(spark, folder):
    """Scores kept apart from their rows, joined back by file, batch and position."""
    docs = table(spark, folder, "documents").select("doc_id", F.col("doc_id").cast("string").alias("key"))
    rows = scoring.assign_batches(docs, "key", FILES).drop("key")
    scores = scoring.parse_replies(_answered_documents(spark, folder), strict=False)
    return scoring.attach_by_position(rows, scores.select("file_no", "batch_no", "pos", "sentiment_score"))


@query(
    "score_violations",
    with_ctes(
        """SELECT sentence_uuid, sentiment_score, lang AS category FROM answers
        WHERE lang NOT IN ('en', 'fr') AND NOT bad""",
        "answers",
    ),
)
def _(spark, folder):
    scored = scoring.classified(scoring.parse_replies(_answered_documents(spark, folder), strict=False))
    return quality.score_violations(scored, ("en", "fr")).drop("keyword")


@query("retry_pending", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, folder):
    return recovery.pending(table(spark, folder, "documents"), table(spark, folder, "labels"), "doc_id")


@query(
    "merged_failures",
    """SELECT DISTINCT source || '/' || lang AS target FROM documents
    UNION SELECT DISTINCT trim(role, ' ') FROM conversations""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select(F.concat_ws("/", "source", "lang").alias("x"))
    roles = table(spark, folder, "conversations").select(F.concat(F.lit(" "), "role", F.lit("  ")).alias("y"))
    return recovery.merged_failures(docs, roles)


@query(
    "latest_attempt",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
      ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def _(spark, folder):
    """Events as repeated attempts: the newest per user and type."""
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    rows = table(spark, folder, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return recovery.latest_attempt(rows, ["user_id", "event_type"], order).drop("ts")


@query(
    "fk_orphans",
    """SELECT 'doc_id' AS reference, CAST(doc_id AS VARCHAR) AS value, count(*) AS rows FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id
    UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) FROM events
      WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id""",
)
def _(spark, folder):
    def report(name, orphans):
        return orphans.select(F.lit(name).alias("reference"), F.col(name).cast("string").alias("value"), "rows")

    docs, events = table(spark, folder, "documents"), table(spark, folder, "events")
    unlabelled = quality.fk_orphans(docs, table(spark, folder, "labels"), ["doc_id"])
    strangers = quality.fk_orphans(events, table(spark, folder, "supplier"), ["user_id"], ["s_suppkey"])
    return report("doc_id", unlabelled).unionByName(report("user_id", strangers))


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def _(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])
