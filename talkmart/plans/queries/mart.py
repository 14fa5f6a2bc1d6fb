"""Staging to warehouse: dedupe, merge, facts, views, comparisons."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from talkmart.functions.timefn import to_epoch, to_local_date
from talkmart.operators import facts, upsert, views
from talkmart.plans.queries import shapes as S
from talkmart.plans.load import stored_dimension
from talkmart.plans.queries.registry import RUN_DATE, cte, query, scratch_folder, sql_epoch, stored, stored_steps, table, with_ctes
from talkmart.sources import versions


@query(
    "dedupe_posts",
    """SELECT text_key, doc_id, lang, source, n_chars FROM (SELECT md5(text) AS text_key, *, row_number() OVER
      (PARTITION BY md5(text) ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn = 1""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select(
        F.md5("text").alias("text_key"), "doc_id", "lang", "source", "n_chars"
    )
    return upsert.latest_per_key(docs, ["text_key"], newest="doc_id")


def _line_versions(spark, folder):
    """Line items as versions of their order's post: one post comes many times."""
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("order_"), "l_orderkey").alias("post_id"),
        F.concat(F.lit("shipped part "), "l_partkey").alias("title"),
        F.concat(F.lit("supplier "), "l_suppkey").alias("author"),
        F.concat_ws("\n", F.lit("line"), "l_linenumber", "l_returnflag").alias("article"),
        to_epoch(F.col("l_shipdate")).alias("create_timestamp"),
    )


cte(
    "line_versions",
    f"""SELECT 'order_' || l_orderkey AS post_id, 'shipped part ' || l_partkey AS title,
      'supplier ' || l_suppkey AS author, 'line' || chr(10) || l_linenumber || chr(10) || l_returnflag AS article,
      {sql_epoch('l_shipdate')} AS create_timestamp FROM lineitem""",
)
cte(
    "posts_to_load",
    f"""SELECT post_id, title, author, article, {S.sql_seoul_day('create_timestamp')} AS create_date
    FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY create_timestamp DESC, title, author, article) AS rn
      FROM line_versions) WHERE rn = 1""",
    ("line_versions",),
)
cte(
    "posts_before",
    f"""SELECT post_id, title, author, article, {S.sql_seoul_day('create_timestamp')} AS create_date
    FROM staged_posts WHERE comment_cnt IS NOT NULL""",
    ("staged_posts",),
)


def _posts_before(spark, folder):
    """Orders that are not pending, as the post dimension before the load."""
    known = S.staged_posts(spark, folder).filter(F.col("comment_cnt").isNotNull())
    return known.select("post_id", "title", "author", "article", to_local_date(F.col("create_timestamp")).alias("create_date"))


_MERGED_POSTS = with_ctes(
    """SELECT coalesce(s.post_id, t.post_id) AS post_id, CASE WHEN s.post_id IS NULL THEN t.title ELSE s.title END AS title,
      CASE WHEN s.post_id IS NULL THEN t.author ELSE s.author END AS author,
      CASE WHEN s.post_id IS NULL THEN t.article ELSE s.article END AS article,
      CASE WHEN s.post_id IS NULL THEN t.create_date ELSE s.create_date END AS create_date
    FROM posts_before t FULL JOIN posts_to_load s ON t.post_id = s.post_id""",
    "posts_before",
    "posts_to_load",
)


@query("upsert_posts", _MERGED_POSTS)
def _(spark, folder):
    return upsert.merge_posts(_posts_before(spark, folder), upsert.posts_to_load(_line_versions(spark, folder)))


@query("upsert_posts_small", _MERGED_POSTS)
def _(spark, folder):
    """The same merge with the source broadcast, while it is small: written first, its size is known."""
    source = stored(upsert.posts_to_load(_line_versions(spark, folder)), "load")
    return upsert.merge_posts(_posts_before(spark, folder), source, small_source=upsert.is_small(source))


cte(
    "dated_versions",
    f"""SELECT 'order_' || l_orderkey AS post_id, 'shipped part ' || l_partkey AS title, 'supplier ' || l_suppkey AS author,
      'line' || chr(10) || l_linenumber || chr(10) || l_returnflag AS article, {sql_epoch('l_shipdate')} AS create_timestamp,
      CAST(l_shipdate AS DATE) AS load_day, l_returnflag AS load_car FROM lineitem""",
)


_LATE_DAYS = with_ctes(
    f"""SELECT post_id, title, author, article, {S.sql_seoul_day('create_timestamp')} AS create_date, load_day, load_car
    FROM (SELECT *, row_number() OVER (PARTITION BY post_id
        ORDER BY load_day DESC, load_car DESC, create_timestamp DESC, title, author, article) AS rn FROM dated_versions)
    WHERE rn = 1""",
    "dated_versions",
)


def _loads(spark, folder):
    """The line items of three cars, one load each, the latest car first."""
    flag = F.element_at(F.split("article", "\n"), 3)
    day = table(spark, folder, "lineitem").select(
        F.concat(F.lit("order_"), "l_orderkey").alias("post_id"),
        F.concat(F.lit("shipped part "), "l_partkey").alias("title"),
        F.concat(F.lit("supplier "), "l_suppkey").alias("author"),
        F.concat_ws("\n", F.lit("line"), "l_linenumber", "l_returnflag").alias("article"),
        to_epoch(F.col("l_shipdate")).alias("create_timestamp"),
        F.to_date("l_shipdate").alias("dt"),
    )
    return [upsert.posts_to_load(day.withColumn("car_name", flag).filter(flag == car), loaded=True) for car in "RNA"]


@query("upsert_late_days", _LATE_DAYS)
def _(spark, folder):
    """Loads of three cars one after another, the latest first: none is lost and no older row comes back."""
    loads = _loads(spark, folder)
    table_ = loads[0]
    for may_be_small, load in zip((False, True), loads[1:], strict=True):
        if may_be_small:  # written first, its size is known
            load = stored(load, "load")
        table_ = upsert.merge_posts(table_, load, small_source=may_be_small and upsert.is_small(load), order=upsert.LOADED)
    return table_


@query("upsert_versions", _LATE_DAYS)
def _(spark, folder):
    """The same loads into a stored table of versions, each of which writes the rows that it changes."""
    base, schema = scratch_folder(spark, "posts"), stored_dimension("tb_posts")
    merger = partial(upsert.merge_posts, order=upsert.LOADED)
    for load in _loads(spark, folder):
        # Written first, as in ``plans.load``: a load is read several times.
        versions.upsert_keyed(stored(load, "load"), base, schema, ("post_id",), merger, buckets=32)
    return versions.read_keyed(spark, base, schema, ("post_id",))


def _line_comments(spark, folder):
    """Staged comments whose id is order and line number, which repeats."""
    number = table(spark, folder, "lineitem").select(
        F.concat_ws("_", F.lit("order"), "l_orderkey", "l_linenumber").alias("comment_id"),
        F.concat(F.lit("supplier "), "l_suppkey").alias("author"),
        F.concat(F.lit("part "), "l_partkey", F.lit(" came with flag "), "l_returnflag").alias("content"),
        to_epoch(F.col("l_shipdate")).alias("create_timestamp"),
        S.stable_key(F.lit(RUN_DATE), F.concat(F.lit("order_"), F.col("l_orderkey").cast("string"))).alias("post_uuid"),
    )
    return number


cte(
    "comments_to_load",
    f"""SELECT post_id, comment_id, author, content, {S.sql_seoul_day('create_timestamp')} AS create_date
    FROM (SELECT *, row_number() OVER (PARTITION BY comment_id ORDER BY create_timestamp DESC, author, content, post_id) AS rn
      FROM (SELECT p.post_id, order_id || '_' || l_linenumber AS comment_id, c.author, c.content,
          {sql_epoch('l_shipdate')} AS create_timestamp
        FROM line_comments c JOIN staged_posts p ON p.post_uuid = c.post_uuid)) WHERE rn = 1""",
    ("line_comments", "staged_posts"),
)


@query("comment_dedupe", with_ctes("SELECT * FROM comments_to_load", "comments_to_load"))
def _(spark, folder):
    return upsert.comments_to_load(_line_comments(spark, folder), S.staged_posts(spark, folder))


cte(
    "comments_before",
    """SELECT DISTINCT 'order_' || l_orderkey AS post_id, 'order_' || l_orderkey || '_' || l_linenumber AS comment_id,
      'nobody' AS author, 'first seen' AS content, DATE '1995-01-01' AS create_date
    FROM lineitem WHERE l_linestatus = 'F'
    UNION ALL SELECT 'order_' || o_orderkey, 'order_' || o_orderkey || '_0', 'nobody', 'kept', DATE '1995-01-01' FROM orders""",
)


@query(
    "upsert_comments",
    with_ctes(
        """SELECT CASE WHEN t.comment_id IS NULL THEN s.post_id ELSE t.post_id END AS post_id,
          coalesce(t.comment_id, s.comment_id) AS comment_id,
          CASE WHEN s.comment_id IS NULL THEN t.author ELSE s.author END AS author,
          CASE WHEN s.comment_id IS NULL THEN t.content ELSE s.content END AS content,
          CASE WHEN s.comment_id IS NULL THEN t.create_date ELSE s.create_date END AS create_date
        FROM comments_before t FULL JOIN comments_to_load s ON t.comment_id = s.comment_id""",
        "comments_before",
        "comments_to_load",
    ),
)
def _(spark, folder):
    items, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    first_day = F.lit("1995-01-01").cast("date").alias("create_date")

    def known(df, key, number, content):
        post_id = F.concat(F.lit("order_"), key)
        return df.select(
            post_id.alias("post_id"),
            F.concat_ws("_", post_id, number).alias("comment_id"),
            F.lit("nobody").alias("author"),
            F.lit(content).alias("content"),
            first_day,
        )

    seen = known(items.filter("l_linestatus = 'F'"), "l_orderkey", F.col("l_linenumber"), "first seen").distinct()
    target = seen.unionByName(known(orders, "o_orderkey", F.lit(0), "kept"))
    incoming = upsert.comments_to_load(_line_comments(spark, folder), S.staged_posts(spark, folder))
    return upsert.merge_comments(target, incoming)


@query("append_post_metric", with_ctes("SELECT * FROM post_facts", "post_facts"))
def _(spark, folder):
    return facts.post_metrics(S.dated(S.staged_posts(spark, folder)), day_column="created_on")


def _comment_facts(spark, folder):
    comments, posts = S.staged_comments(spark, folder), S.staged_posts(spark, folder)
    return facts.comment_metrics(S.dated(comments), posts, day_column="created_on")


@query("append_comment_metric", with_ctes("SELECT * FROM comment_facts", "comment_facts"))
def _(spark, folder):
    return _comment_facts(spark, folder)


@query(
    "append_comment_metric_uuid",
    with_ctes(
        f"""SELECT p.post_id, c.comment_uuid AS comment_id, p.car_name, p.source, c.like_cnt, c.dislike_cnt,
          DATE '{RUN_DATE}' AS ingestion_date
        FROM staged_comments c JOIN staged_posts p ON p.post_uuid = c.post_uuid""",
        "staged_comments",
        "staged_posts",
    ),
)
def _(spark, folder):
    """The variant that stores the comment's run-local key."""
    return facts.comment_metrics(
        S.staged_comments(spark, folder), S.staged_posts(spark, folder), RUN_DATE, compat_uuid=True
    )


def _keyword_facts(spark, folder, **steps):
    # Posts are used three times: written once, their joins move the orders once.
    posts = S.staged_posts(spark, folder).drop("author", "like_cnt", "dislike_cnt", "view_cnt", "comment_cnt")
    posts, comments = stored(posts, "posts"), S.staged_comments(spark, folder)
    return facts.keyword_facts(
        S.staged_sentences(posts, comments),
        S.staged_keywords(posts, comments),
        S.dated(posts),
        comments,
        day_column="created_on",
        **steps,
    )


@query("append_keywords", with_ctes("SELECT * FROM keyword_facts", "keyword_facts"))
def _(spark, folder):
    return _keyword_facts(spark, folder, step=stored_steps())


def _dims(spark, folder):
    return S.car_dim(spark, folder), S.source_dim(spark, folder)


_LISTENING = """SELECT k.post_id, CASE WHEN k.type = 'comment' THEN k.comment_id END AS comment_id, k.type, k.sentence,
  k.category, k.keyword, k.sentiment_score, k.ingestion_date, k.car_name, c.pre_car_name, c.release_date, k.source, w.age
FROM keyword_facts k JOIN cars c ON k.car_name = c.car_name JOIN sources w ON k.source = w.source"""
cte("listening", _LISTENING, ("keyword_facts", "cars", "sources"))


def _listening(spark, folder, **steps):
    return views.social_listening(_keyword_facts(spark, folder, **steps), *_dims(spark, folder))


@query("social_listening", with_ctes("SELECT * FROM listening", "listening"))
def _(spark, folder):
    return _listening(spark, folder, step=stored_steps())


cte(
    "attention",
    """SELECT p.post_id, c.comment_id, CASE WHEN c.comment_id IS NULL THEN p.like_cnt ELSE c.like_cnt END AS like_cnt,
      CASE WHEN c.comment_id IS NULL THEN p.dislike_cnt ELSE c.dislike_cnt END AS dislike_cnt,
      p.view_cnt, p.comment_cnt, p.ingestion_date, p.car_name, car.pre_car_name, car.release_date, p.source, w.age
    FROM post_facts p LEFT JOIN comment_facts c ON p.post_id = c.post_id
      JOIN cars car ON p.car_name = car.car_name JOIN sources w ON p.source = w.source""",
    ("post_facts", "comment_facts", "cars", "sources"),
)


def _metric_facts(spark, folder):
    posts, comments = S.staged_posts(spark, folder), S.staged_comments(spark, folder)
    return (
        facts.post_metrics(S.dated(posts), day_column="created_on"),
        facts.comment_metrics(S.dated(comments), posts, day_column="created_on"),
    )


@query("social_attention", with_ctes("SELECT * FROM attention", "attention"))
def _(spark, folder):
    return views.social_attention(
        *_metric_facts(spark, folder), *_dims(spark, folder)
    )


_SAME_DAY = with_ctes(
    """SELECT p.post_id, c.comment_id, CASE WHEN c.comment_id IS NULL THEN p.like_cnt ELSE c.like_cnt END AS like_cnt,
      CASE WHEN c.comment_id IS NULL THEN p.dislike_cnt ELSE c.dislike_cnt END AS dislike_cnt,
      p.view_cnt, p.comment_cnt, p.ingestion_date, p.car_name, car.pre_car_name, car.release_date, p.source, w.age
    FROM post_facts p LEFT JOIN comment_facts c ON p.post_id = c.post_id AND p.ingestion_date = c.ingestion_date
      JOIN cars car ON p.car_name = car.car_name JOIN sources w ON p.source = w.source""",
    "post_facts",
    "comment_facts",
    "cars",
    "sources",
)


@query("social_attention_same_day", _SAME_DAY)
def _(spark, folder):
    return views.social_attention(
        *_metric_facts(spark, folder), *_dims(spark, folder), same_day=True
    )


@query("attention_changes", _SAME_DAY)
def _(spark, folder):
    """The view of an earlier state, brought up to date by the posts whose facts differ since.

    Then, days from 1997 on were not loaded, comments with an even number of likes were missing, and the posts of one
    source had other counters.
    """
    # Both states, both sets of fingerprints and the new rows come from the facts: written once, their joins run once.
    posts, comments = (stored(df, name) for df, name in zip(_metric_facts(spark, folder), ("posts", "comments"), strict=True))
    loaded = F.col("ingestion_date") < F.lit("1997-01-01").cast("date")
    other = F.when(F.col("source") == "ASIA", F.coalesce("view_cnt", F.lit(0)) + 1).otherwise(F.col("view_cnt"))
    then = posts.filter(loaded).withColumn("view_cnt", other), comments.filter(loaded & F.expr("like_cnt % 2 = 1"))
    dims = _dims(spark, folder)
    view = views.social_attention(*then, *dims, same_day=True)
    changed = stored(views.changed_posts(views.fact_fingerprints(*then), views.fact_fingerprints(posts, comments)), "changed")
    return views.apply_changes(view, changed, posts, comments, *dims)


_MEAN = "CAST(sum(CAST(sentiment_score AS DECIMAL(18, 6))) AS DOUBLE) / count(*)"
_PHASE = "CASE WHEN ingestion_date < release_date THEN 'before' WHEN ingestion_date >= release_date THEN 'after' END"


@query(
    "facelift_sentiment",
    with_ctes(
        f"""SELECT {_PHASE} AS phase, car_name, category, count(*) AS sentences,
          {_MEAN} AS avg_sentiment FROM listening GROUP BY 1, 2, 3""",
        "listening",
    ),
)
def _(spark, folder):
    return views.facelift_sentiment(_listening(spark, folder))


@query(
    "facelift_sentiment_totals",
    with_ctes(
        f"""SELECT phase, age, category, count(*) AS sentences, {_MEAN} AS avg_sentiment
        FROM (SELECT *, {_PHASE} AS phase FROM listening) GROUP BY ROLLUP (phase, age, category)""",
        "listening",
    ),
)
def _(spark, folder):
    return views.facelift_sentiment(_listening(spark, folder), ("age", "category"), subtotals=True)


@query(
    "facelift_keywords",
    with_ctes(
        """SELECT car_name, keyword, count(*) FILTER (ingestion_date < release_date) AS n_before,
          count(*) FILTER (ingestion_date >= release_date) AS n_after,
          CAST(sum(CAST(sentiment_score AS DECIMAL(18, 6))) FILTER (ingestion_date < release_date) AS DOUBLE)
            / nullif(count(*) FILTER (ingestion_date < release_date), 0) AS avg_before,
          CAST(sum(CAST(sentiment_score AS DECIMAL(18, 6))) FILTER (ingestion_date >= release_date) AS DOUBLE)
            / nullif(count(*) FILTER (ingestion_date >= release_date), 0) AS avg_after
        FROM listening GROUP BY car_name, keyword""",
        "listening",
    ),
)
def _(spark, folder):
    return views.keyword_shift(_listening(spark, folder))


@query(
    "attention_daily",
    with_ctes(
        """SELECT ingestion_date, car_name, source, CAST(count(DISTINCT post_id) AS BIGINT) AS post_rows,
          count(comment_id) AS comment_rows, CAST(sum(coalesce(like_cnt, 0)) AS BIGINT) AS likes,
          CAST(sum(coalesce(dislike_cnt, 0)) AS BIGINT) AS dislikes
        FROM attention GROUP BY ingestion_date, car_name, source""",
        "attention",
    ),
)
def _(spark, folder):
    return views.attention_daily(
        *_metric_facts(spark, folder), *_dims(spark, folder)
    )
