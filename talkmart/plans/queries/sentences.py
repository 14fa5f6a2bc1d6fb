"""Records, sentences, cleaning, quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkmart.functions.keys import content_key, path_id, query_id, stable_key
from talkmart.functions.text import clean_flat_text, clean_sentences
from talkmart.operators import normalize, quarantine
from talkmart.plans.queries import shapes as S
from talkmart.plans.queries.registry import RUN_DATE, cte, query, sql_clean, sql_epoch, sql_key, table, with_ctes
from talkmart.schemas import RAW

_CLEANED = """SELECT * FROM (SELECT doc_id, pos, {clean} AS sentence FROM noisy_lines
      WHERE length(line) > 10 AND regexp_matches(line, '[a-z]')) WHERE length(sentence) > 10"""

cte(
    "noisy_lines",
    f"""SELECT doc_id, unnest(string_split(noisy, chr(10))) AS line,
      CAST(generate_subscripts(string_split(noisy, chr(10)), 1) - 1 AS INTEGER) AS pos
    FROM (SELECT doc_id, {S.SQL_NOISY} AS noisy FROM documents)""",
)


@query("clean_sentences", with_ctes(_CLEANED.format(clean=sql_clean("line")), "noisy_lines"))
def _(spark, folder):
    docs = table(spark, folder, "documents")
    lines = F.split(S.noisy_text(F.col("text"), F.col("doc_id")), "\n")
    rows = docs.select("doc_id", F.posexplode(lines).alias("pos", "sentence"))
    return clean_sentences(rows, script=S.LATIN)


_NOISY_FLAT = f"""SELECT title AS text, date, like_count, view_count, source FROM noisy_raw
    UNION ALL SELECT unnest(string_split(article, chr(10))), date, like_count, view_count, source FROM noisy_raw
    UNION ALL SELECT comment_content, comment_date, comment_like_count, NULL, source FROM raw_comments"""
cte("noisy_raw", f"SELECT * REPLACE ({S.SQL_NOISY.replace('text ||', 'article ||').replace('doc_id', 'view_count')} AS article) FROM raw", ("raw",))


@query(
    "clean_prototype",
    with_ctes(
        f"""SELECT * FROM (SELECT regexp_replace({sql_clean('text')}, '투산+', '투싼', 'g') AS text, date, like_count,
            view_count, source FROM ({_NOISY_FLAT}))
        WHERE regexp_matches(text, '[a-z]') AND length(text) > 10""",
        "noisy_raw",
        "raw_comments",
    ),
)
def _(spark, folder):
    raw = S.raw_documents(spark, folder)
    noisy = raw.withColumn("article", S.noisy_text(F.col("article"), F.col("view_count")))
    return clean_flat_text(normalize.flatten_text(noisy), script=S.LATIN)


@query(
    "flatten_text",
    with_ctes(
        """SELECT title AS text, date, like_count, view_count, source FROM raw
        UNION ALL SELECT line, date, like_count, view_count, source FROM raw_lines
        UNION ALL SELECT comment_content, comment_date, comment_like_count, NULL, source FROM raw_comments""",
        "raw_comments",
    ),
)
def _(spark, folder):
    return normalize.flatten_text(S.raw_documents(spark, folder))


@query(
    "flatten_threads",
    """SELECT CAST(conv_id AS VARCHAR) AS text, 'title' AS part FROM conversations WHERE turn = 0
    UNION ALL SELECT unnest(string_split(text, chr(10))), 'article' FROM conversations WHERE turn = 0
    UNION ALL SELECT text, 'comment' FROM conversations
      WHERE turn > 0 AND conv_id IN (SELECT conv_id FROM conversations WHERE turn = 0)""",
)
def _(spark, folder):
    """First turns as posts with the later turns nested under them, then flattened."""
    turns = table(spark, folder, "conversations")
    nothing = F.lit(0)
    posts = turns.filter("turn = 0").select(
        "conv_id",
        F.col("conv_id").cast("string").alias("title"),
        F.col("text").alias("article"),
        F.lit(1).alias("date"),
        nothing.alias("like_count"),
        nothing.alias("view_count"),
        F.lit("article").alias("source"),
    )
    replies = turns.filter("turn > 0").select(
        "conv_id",
        "turn",
        F.col("text").alias("comment_content"),
        F.lit(2).alias("comment_date"),
        nothing.alias("comment_like_count"),
    )
    fields = ["comment_content", "comment_date", "comment_like_count"]
    nested = normalize.nest_comments(posts, replies, "conv_id", ["turn"], fields)
    # A post that comes as several records has its own text in the first only.
    texts = nested.withColumns(
        {c: F.when(F.col("record_part") == 0, F.col(c)) for c in ("title", "article")}
    )
    flat = normalize.flatten_text(texts).filter(F.col("text").isNotNull())
    is_title = (F.col("date") == 1) & F.col("text").rlike("^[0-9]+$")
    part = F.when(F.col("date") == 2, "comment").when(is_title, "title").otherwise("article")
    return flat.select("text", part.alias("part"))


_PACKED = "l_linenumber || ':' || l_partkey || ':' || l_suppkey || ':' || l_returnflag"


@query(
    "nest_records",
    f"""SELECT o_orderkey, 0 AS record_part, CAST(count(l_orderkey) AS INTEGER) AS comment_count,
      md5(coalesce(string_agg({_PACKED}, '|' ORDER BY l_linenumber, l_partkey, l_suppkey), '')) AS digest
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    items = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    order_by = ["l_linenumber", "l_partkey", "l_suppkey"]
    nested = normalize.nest_comments(orders, items, "o_orderkey", order_by, [*order_by, "l_returnflag"])
    packed = F.transform("comments", lambda c: F.concat_ws(":", *(c[f] for f in (*order_by, "l_returnflag"))))
    return nested.select(
        "o_orderkey", "record_part", "comment_count", F.md5(F.array_join(packed, "|")).alias("digest")
    )


_POST_UUID = sql_key(f"'{RUN_DATE}'", "id")
cte("keyed", f"SELECT *, {_POST_UUID} AS post_uuid FROM raw", ("raw",))
cte(
    "keyed_comments",
    f"""SELECT {_POST_UUID} AS post_uuid, id || '_' || {sql_key('comment_nickname', 'comment_content')} AS comment_id,
      {sql_key(_POST_UUID, "'comment'", 'pos')} AS comment_uuid, comment_nickname AS author, comment_content AS content,
      comment_date AS create_timestamp, comment_like_count AS like_cnt, comment_dislike_count AS dislike_cnt
    FROM raw_comments WHERE comment_count > 0""",
    ("raw_comments",),
)


@query(
    "split_post",
    with_ctes(
        """SELECT post_uuid, id AS post_id, title, nickname AS author, article, date AS create_timestamp,
          like_count AS like_cnt, dislike_count AS dislike_cnt, view_count AS view_cnt, comment_count AS comment_cnt,
          car_name, source FROM keyed""",
        "keyed",
    ),
)
def _(spark, folder):
    posts, _comments = normalize.split_records(S.raw_documents(spark, folder), RUN_DATE)
    return posts


@query("split_comment", with_ctes("SELECT * FROM keyed_comments", "keyed_comments"))
def _(spark, folder):
    _posts, comments = normalize.split_records(S.raw_documents(spark, folder), RUN_DATE)
    return comments


@query(
    "split_sentences",
    with_ctes(
        f"""SELECT post_uuid, CAST(NULL AS VARCHAR) AS comment_uuid, {sql_key('post_uuid', "'post'", 'pos')} AS sentence_uuid,
          'post' AS type, line AS sentence
        FROM (SELECT post_uuid, unnest(list_prepend(title, string_split(article, chr(10)))) AS line,
            generate_subscripts(list_prepend(title, string_split(article, chr(10))), 1) - 1 AS pos FROM keyed)
        UNION ALL
        SELECT post_uuid, comment_uuid, {sql_key('comment_uuid', "'comment'", '0')}, 'comment', content FROM keyed_comments""",
        "keyed",
        "keyed_comments",
    ),
)
def _(spark, folder):
    posts, comments = normalize.split_records(S.raw_documents(spark, folder), RUN_DATE)
    return normalize.sentence_rows(posts, comments)


def _judged_documents(spark, folder):
    """Documents as records; likes from the labels: NULL where unlabelled, -1 where toxic."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return docs.select(
        "text",
        "lang",
        "source",
        F.col("n_chars").alias("view_count"),
        (F.col("quality") - F.col("toxic") * 2).alias("like_count"),
    )


cte(
    "judged",
    """SELECT text, lang, source, n_chars AS view_count, quality - toxic * 2 AS like_count
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
_GOOD = """text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND view_count IS NOT NULL
  AND like_count IS NOT NULL AND like_count >= 0 AND view_count >= 0"""
_JUDGED_COUNTERS = ("like_count", "view_count")


@query("quarantine_good", with_ctes(f"SELECT * FROM judged WHERE {_GOOD}", "judged"))
def _(spark, folder):
    return quarantine.good_rows(_judged_documents(spark, folder), _JUDGED_COUNTERS)


@query(
    "quarantine_bad",
    with_ctes(
        f"""SELECT *, CASE WHEN like_count IS NULL THEN 'like_count missing' ELSE 'like_count negative' END AS reasons
        FROM judged WHERE NOT coalesce(({_GOOD}), false)""",
        "judged",
    ),
)
def _(spark, folder):
    bad = quarantine.rejected_rows(_judged_documents(spark, folder), _JUDGED_COUNTERS)
    return bad.withColumn("reasons", F.array_join("reject_reasons", ", ")).drop("reject_reasons")


@query(
    "quarantine_distinct",
    with_ctes(f"SELECT * FROM judged EXCEPT SELECT * FROM judged WHERE {_GOOD}", "judged"),
)
def _(spark, folder):
    return quarantine.rejected_distinct(_judged_documents(spark, folder), _JUDGED_COUNTERS)


_INT = "CASE WHEN {x} BETWEEN -2147483648 AND 2147483647 THEN CAST({x} AS INTEGER) END"


@query(
    "ingest_raw_json",
    f"""SELECT 'doc_' || doc_id AS id, {_INT.format(x='n_chars * 1000000')} AS view_count,
      CASE WHEN lang <> 'de' THEN CAST(n_chars % 100 AS INTEGER) END AS like_count,
      CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_comments,
      n_chars * 1000000 > 2147483647 OR lang = 'de' AS rejected
    FROM documents""",
)
def _(spark, folder):
    """JSON text read with the raw schema: numbers too large and text in number fields become NULL."""
    d = table(spark, folder, "documents")
    likes = F.pmod("n_chars", F.lit(100)).cast("string")
    reply = F.struct(
        F.lit(1).alias("comment_date"), F.lit(0).alias("comment_like_count"), F.lit(0).alias("comment_dislike_count")
    )
    comments = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            line.alias("comment_content"), F.lit("n").alias("comment_nickname"), *(reply[f] for f in
            ("comment_date", "comment_like_count", "comment_dislike_count"))
        ),
    )
    record = F.struct(
        F.col("lang").alias("car_name"),
        "source",
        F.concat(F.lit("doc_"), "doc_id").alias("id"),
        F.lit("t").alias("title"),
        F.lit("n").alias("nickname"),
        F.col("text").alias("article"),
        (F.col("n_chars") * 1000000).alias("view_count"),
        F.lit(0).alias("dislike_count"),
        F.lit(1).alias("date"),
        F.lit(1).alias("comment_count"),
        F.to_json(comments).alias("comments_text"),
    )
    # The likes field is put in as text: quoted, so a wrong type, for one language.
    mark = F.when(F.col("lang") == "de", F.concat(F.lit('"'), likes, F.lit('"'))).otherwise(likes)
    head = F.regexp_replace(F.to_json(record.dropFields("comments_text")), r"\}$", "")
    json = F.concat(head, F.lit(',"like_count":'), mark, F.lit(',"comments":'), F.to_json(comments), F.lit("}"))
    parsed = d.select(F.from_json(json, RAW).alias("r")).select("r.*")
    return parsed.select(
        "id",
        "view_count",
        "like_count",
        F.size("comments").alias("n_comments"),
        quarantine.is_rejected(parsed).alias("rejected"),
    )


@query(
    "content_key",
    f"""SELECT conv_id, turn, conv_id || '_' || {sql_key('role', 'text')} AS comment_id,
      {sql_key('conv_id', 'turn', 'NULL')} AS row_key FROM conversations""",
)
def _(spark, folder):
    rows = table(spark, folder, "conversations")
    return rows.select(
        "conv_id",
        "turn",
        content_key(F.col("conv_id").cast("string"), F.col("role"), F.col("text")).alias("comment_id"),
        stable_key(F.col("conv_id"), F.col("turn"), F.lit(None)).alias("row_key"),
    )


@query(
    "id_from_url",
    """SELECT page_id, list_last(string_split(url, '=')) AS query_id,
      list_last(string_split(split_part(url, '?', 1), '/')) AS path_id FROM pages""",
)
def _(spark, folder):
    url = F.col("url")
    return table(spark, folder, "pages").select("page_id", query_id(url).alias("query_id"), path_id(url).alias("path_id"))
