"""The given tables in the shape of posts, comments and dimensions.

Documents are posts whose lines are also their comments; orders are posts whose
line items are their comments; nations are cars and regions are web sources.
Every builder is a projection or a join over whole tables, and has the same rows
written as a common table expression for the checking SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmart.functions.keys import content_key, stable_key
from talkmart.functions.text import clean_sentences
from talkmart.functions.timefn import to_epoch, to_local_date
from talkmart.operators import normalize
from talkmart.plans.queries.registry import RUN_DATE, cte, sql_clean, sql_epoch, sql_key, table
from talkmart.schemas import RAW

LATIN = "[a-z]"
NEW_YEAR = 1704067200  # 2024-01-01T00:00:00Z


def noisy_text(text: Column, doc_id: Column) -> Column:
    """Document text plus lines with links, handles, tags, marks and Hangul."""
    return F.concat(
        text,
        F.lit("\nRead http://example.com/"),
        doc_id.cast("string"),
        F.lit(' by @writer #tag now,, "quoted" [x] wow!!! ok..\n투산투산 is 투산산 here \u00a0and\u200b there  '),
        doc_id.cast("string"),
        F.lit("\nshort\n"),
    )


SQL_NOISY = (
    "text || chr(10) || 'Read http://example.com/' || doc_id || "
    "' by @writer #tag now,, \"quoted\" [x] wow!!! ok..' || chr(10) || '투산투산 is 투산산 here ' || chr(160) || "
    "'and' || chr(8203) || ' there  ' || doc_id || chr(10) || 'short' || chr(10)"
)


def raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Nested raw records, one per document; its lines are its comments."""
    d = table(spark, folder, "documents")
    posted = (F.lit(NEW_YEAR) + F.pmod(F.col("doc_id") * 977, F.lit(2592000))).cast("int")
    comments = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            line.alias("comment_content"),
            F.concat(F.lit("reader_"), F.pmod(i, F.lit(3)).cast("string")).alias("comment_nickname"),
            (F.col("date") + i * 60).cast("int").alias("comment_date"),
            F.pmod(F.length(line), F.lit(50)).alias("comment_like_count"),
            F.pmod(i, F.lit(4)).alias("comment_dislike_count"),
        ),
    )
    chars = F.col("n_chars")
    return (
        d.withColumn("date", posted)
        .withColumn("comments", comments)
        .select(
            F.col("lang").alias("car_name"),
            "source",
            F.concat_ws("_", "source", "doc_id").alias("id"),
            F.concat(F.lit("post "), F.col("doc_id"), F.lit(" in "), F.col("lang")).alias("title"),
            F.concat_ws("_", "lang", "source").alias("nickname"),
            F.col("text").alias("article"),
            chars.cast("int").alias("view_count"),
            F.pmod(chars, F.lit(97)).cast("int").alias("like_count"),
            F.pmod(chars, F.lit(7)).cast("int").alias("dislike_count"),
            "date",
            # Some posts state no comments although their array has some.
            F.when(F.pmod(chars, F.lit(5)) == 0, 0).otherwise(F.size("comments")).alias("comment_count"),
            "comments",
        )
        .select(*RAW.fieldNames())
    )


cte(
    "raw",
    f"""SELECT lang AS car_name, source, source || '_' || doc_id AS id,
      'post ' || doc_id || ' in ' || lang AS title, lang || '_' || source AS nickname, text AS article,
      CAST(n_chars AS INTEGER) AS view_count, CAST(n_chars % 97 AS INTEGER) AS like_count,
      CAST(n_chars % 7 AS INTEGER) AS dislike_count,
      CAST({NEW_YEAR} + (doc_id * 977) % 2592000 AS INTEGER) AS date,
      CAST(CASE WHEN n_chars % 5 = 0 THEN 0 ELSE len(string_split(text, chr(10))) END AS INTEGER) AS comment_count
    FROM documents""",
)
cte(
    "raw_lines",
    """SELECT *, unnest(string_split(article, chr(10))) AS line,
      generate_subscripts(string_split(article, chr(10)), 1) - 1 AS pos
    FROM raw""",
    ("raw",),
)
cte(
    "raw_comments",
    """SELECT *, line AS comment_content, 'reader_' || (pos % 3) AS comment_nickname,
      CAST(date + pos * 60 AS INTEGER) AS comment_date, CAST(length(line) % 50 AS INTEGER) AS comment_like_count,
      CAST(pos % 4 AS INTEGER) AS comment_dislike_count
    FROM raw_lines""",
    ("raw_lines",),
)


def _order_id(key: str) -> Column:
    return F.concat(F.lit("order_"), F.col(key).cast("string"))


def staged_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as staged posts; the customer's nation is the car, its region the source."""
    customers = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name")
    )
    orders = table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    price = F.floor("o_totalprice")
    return orders.select(
        stable_key(F.lit(RUN_DATE), _order_id("o_orderkey")).alias("post_uuid"),
        _order_id("o_orderkey").alias("post_id"),
        F.concat(F.lit("order "), "o_orderkey", F.lit(" is "), "o_orderstatus").alias("title"),
        F.col("c_name").alias("author"),
        F.concat(
            F.lit("placed by "), "c_name", F.lit(" again\npriority "), "o_orderpriority",
            F.lit("\nin segment "), "c_mktsegment", F.lit("\n"),
        ).alias("article"),
        to_epoch(F.col("o_orderdate")).alias("create_timestamp"),
        F.pmod(price, F.lit(1000)).alias("like_cnt"),
        F.pmod("o_custkey", F.lit(11)).cast("bigint").alias("dislike_cnt"),
        price.alias("view_cnt"),
        F.when(F.col("o_orderstatus") != "P", F.pmod("o_orderkey", F.lit(9))).cast("bigint").alias("comment_cnt"),
        F.col("n_name").alias("car_name"),
        F.col("r_name").alias("source"),
    )


cte(
    "staged_posts",
    f"""SELECT {sql_key(f"'{RUN_DATE}'", "'order_' || o_orderkey")} AS post_uuid,
      'order_' || o_orderkey AS post_id, 'order ' || o_orderkey || ' is ' || o_orderstatus AS title,
      c_name AS author,
      'placed by ' || c_name || ' again' || chr(10) || 'priority ' || o_orderpriority || chr(10)
        || 'in segment ' || c_mktsegment || chr(10) AS article,
      {sql_epoch('o_orderdate')} AS create_timestamp,
      CAST(floor(o_totalprice) AS BIGINT) % 1000 AS like_cnt, o_custkey % 11 AS dislike_cnt,
      CAST(floor(o_totalprice) AS BIGINT) AS view_cnt,
      CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 9 END AS comment_cnt,
      n_name AS car_name, r_name AS source
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey""",
)


def staged_comments(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as staged comments on their orders."""
    author = F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string"))
    content = F.concat(F.lit("part "), "l_partkey", F.lit(" came with flag "), "l_returnflag")
    post_uuid = stable_key(F.lit(RUN_DATE), _order_id("l_orderkey"))
    place = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey")]
    return table(spark, folder, "lineitem").select(
        post_uuid.alias("post_uuid"),
        stable_key(post_uuid, F.lit("comment"), *place).alias("comment_uuid"),
        content_key(_order_id("l_orderkey"), author, content).alias("comment_id"),
        author.alias("author"),
        content.alias("content"),
        to_epoch(F.col("l_shipdate")).alias("create_timestamp"),
        F.when(F.col("l_discount") != 0, F.floor("l_quantity")).alias("like_cnt"),
        F.col("l_linenumber").cast("bigint").alias("dislike_cnt"),
    )


cte(
    "line_comments",
    f"""SELECT *, 'order_' || l_orderkey AS order_id, 'supplier ' || l_suppkey AS author,
      'part ' || l_partkey || ' came with flag ' || l_returnflag AS content,
      {sql_key(f"'{RUN_DATE}'", "'order_' || l_orderkey")} AS post_uuid
    FROM lineitem""",
)
cte(
    "staged_comments",
    f"""SELECT post_uuid, {sql_key('post_uuid', "'comment'", 'l_linenumber', 'l_partkey', 'l_suppkey')} AS comment_uuid,
      order_id || '_' || {sql_key('author', 'content')} AS comment_id, author, content,
      {sql_epoch('l_shipdate')} AS create_timestamp,
      CASE WHEN l_discount <> 0 THEN CAST(floor(l_quantity) AS BIGINT) END AS like_cnt,
      CAST(l_linenumber AS BIGINT) AS dislike_cnt
    FROM line_comments""",
    ("line_comments",),
)


def staged_sentences(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Cleaned sentences of the staged posts and comments."""
    return clean_sentences(normalize.sentence_rows(posts, comments), script=LATIN)


cte(
    "all_sentences",
    f"""SELECT post_uuid, CAST(NULL AS VARCHAR) AS comment_uuid, {sql_key('post_uuid', "'post'", 'pos')} AS sentence_uuid,
      'post' AS type, line AS sentence
    FROM (SELECT post_uuid, unnest(list_prepend(title, string_split(article, chr(10)))) AS line,
        generate_subscripts(list_prepend(title, string_split(article, chr(10))), 1) - 1 AS pos FROM staged_posts)
    UNION ALL
    SELECT post_uuid, comment_uuid, {sql_key('comment_uuid', "'comment'", '0')}, 'comment', content FROM staged_comments""",
    ("staged_posts", "staged_comments"),
)
cte(
    "staged_sentences",
    f"""SELECT * FROM (SELECT post_uuid, comment_uuid, sentence_uuid, type, {sql_clean('sentence')} AS sentence
      FROM all_sentences WHERE length(sentence) > 10 AND regexp_matches(sentence, '{LATIN}'))
    WHERE length(sentence) > 10""",
    ("all_sentences",),
)

_KINDS = ("design", "function", "reliability", "other")


def staged_keywords(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """A score, category and keyword for every sentence before cleaning, from its key.

    Sentences that cleaning drops stay in here, so the join with sentences has
    rows on this side without a partner.
    """
    rows = normalize.sentence_rows(posts, comments)
    digits = F.conv(F.substring("sentence_uuid", 1, 6), 16, 10).cast("int")
    category = F.element_at(F.array(*map(F.lit, _KINDS)), F.pmod(digits, F.lit(4)) + 1)
    return rows.select(
        "sentence_uuid",
        (F.pmod(digits, F.lit(11)) / 10).alias("sentiment_score"),
        category.alias("category"),
        F.concat(F.lit("word "), F.pmod(digits, F.lit(50)).cast("string")).alias("keyword"),
    )


cte(
    "staged_keywords",
    """SELECT sentence_uuid, CAST(digits % 11 AS DOUBLE) / 10 AS sentiment_score,
      CASE digits % 4 WHEN 0 THEN 'design' WHEN 1 THEN 'function' WHEN 2 THEN 'reliability' ELSE 'other' END AS category,
      'word ' || (digits % 50) AS keyword
    FROM (SELECT sentence_uuid, CAST('0x' || substr(sentence_uuid, 1, 6) AS BIGINT) AS digits FROM all_sentences)""",
    ("all_sentences",),
)


def car_dim(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, folder, "nation").select(
        F.col("n_name").alias("car_name"),
        F.when(key >= 5, F.concat(F.lit("NATION_"), (key - 5).cast("string"))).alias("pre_car_name"),
        F.date_add(F.lit("1997-01-01").cast("date"), key * 40).alias("release_date"),
    )


cte(
    "cars",
    """SELECT n_name AS car_name, CASE WHEN n_nationkey >= 5 THEN 'NATION_' || (n_nationkey - 5) END AS pre_car_name,
      DATE '1997-01-01' + CAST(n_nationkey * 40 AS INTEGER) AS release_date FROM nation""",
)


def source_dim(spark: SparkSession, folder: str) -> DataFrame:
    decade = F.concat(F.lit(20).cast("int") + F.col("r_regionkey") * 10, F.lit("s"))
    return table(spark, folder, "region").select(F.col("r_name").alias("source"), decade.alias("age"))


cte("sources", "SELECT r_name AS source, (20 + r_regionkey * 10) || 's' AS age FROM region")


def dated(staged: DataFrame) -> DataFrame:
    """Adds ``created_on``, the Seoul day of the row, as the load day of a backfill."""
    return staged.withColumn("created_on", to_local_date(F.col("create_timestamp")))


def sql_seoul_day(epoch: str) -> str:
    """Seoul day of epoch seconds; the zone's daylight-saving years lie before the data."""
    return f"CAST(make_timestamp(({epoch} + 32400) * 1000000) AS DATE)"


cte(
    "post_facts",
    f"""SELECT post_id, car_name, source, like_cnt, dislike_cnt, view_cnt, comment_cnt,
      {sql_seoul_day('create_timestamp')} AS ingestion_date FROM staged_posts""",
    ("staged_posts",),
)
cte(
    "comment_facts",
    f"""SELECT p.post_id, c.comment_id, p.car_name, p.source, c.like_cnt, c.dislike_cnt,
      {sql_seoul_day('c.create_timestamp')} AS ingestion_date
    FROM staged_comments c JOIN staged_posts p ON p.post_uuid = c.post_uuid""",
    ("staged_posts", "staged_comments"),
)
cte(
    "keyword_facts",
    f"""SELECT p.post_id, CASE s.type WHEN 'comment' THEN c.comment_id END AS comment_id, p.car_name, p.source, s.type,
      s.sentence, k.category, k.keyword, k.sentiment_score, {sql_seoul_day('p.create_timestamp')} AS ingestion_date
    FROM staged_sentences s JOIN staged_keywords k ON s.sentence_uuid = k.sentence_uuid
      JOIN staged_posts p ON s.post_uuid = p.post_uuid
      LEFT JOIN staged_comments c ON s.comment_uuid = c.comment_uuid""",
    ("staged_sentences", "staged_keywords", "staged_posts", "staged_comments"),
)
