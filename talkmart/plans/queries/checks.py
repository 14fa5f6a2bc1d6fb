"""Constraint reports and JSON shape checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkmart.operators import facts, quality
from talkmart.plans.queries import shapes as S
from talkmart.plans.queries.registry import query, stored, table, with_ctes
from talkmart.schemas import MART, RAW

_COMMENTS = MART["tb_comments_metric"]


def _rules() -> str:
    """The SQL of every NOT NULL and length rule of the comment metric table."""
    selects = [
        f"SELECT 'not null: {c}' AS rule, count(*) FILTER ({c} IS NULL) AS violations FROM comment_facts"
        for c in _COMMENTS.not_null
    ]
    selects += [
        f"SELECT 'length <= {n}: {c}', count(*) FILTER (length({c}) > {n}) FROM comment_facts"
        for c, n in _COMMENTS.max_length.items()
    ]
    selects.append(
        """SELECT 'post_id, comment_id in tb_comments', count(*) FROM comment_facts f WHERE comment_id IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM staged_comments c WHERE c.comment_id = f.comment_id AND c.like_cnt IS NOT NULL)"""
    )
    selects.append("SELECT 'car_name in tb_car', count(*) FROM comment_facts WHERE car_name NOT IN (SELECT car_name FROM cars)")
    selects.append("SELECT 'source in tb_web_source', count(*) FROM comment_facts WHERE source NOT IN (SELECT source FROM sources)")
    return f"SELECT 'tb_comments_metric' AS table_name, * FROM ({' UNION ALL '.join(selects)})"


@query("constraint_report", with_ctes(_rules(), "comment_facts", "staged_comments", "cars", "sources"))
def _(spark, folder):
    """All declared rules on the comment metrics; the dimension holds the liked comments only."""
    staged = S.staged_comments(spark, folder)
    posts = stored(S.staged_posts(spark, folder).select("post_uuid", "post_id", "car_name", "source"), "posts")
    # Each rule that needs a pass of its own reads the metrics; written once, their join runs once.
    metrics = stored(facts.comment_metrics(S.dated(staged), posts, day_column="created_on"), "metrics")
    liked = staged.filter(F.col("like_cnt").isNotNull()).join(posts.select("post_uuid", "post_id"), "post_uuid")
    dims = {
        "tb_comments": liked.select("post_id", "comment_id"),
        "tb_car": S.car_dim(spark, folder),
        "tb_web_source": S.source_dim(spark, folder),
    }
    return quality.constraint_report(metrics, _COMMENTS, dims)


@query(
    "constraint_report_keys",
    """SELECT 'tb_comments' AS table_name, rule, violations FROM (
      SELECT 'not null: post_id' AS rule, count(*) FILTER (l_orderkey IS NULL) AS violations FROM lineitem
      UNION ALL SELECT 'not null: comment_id', 0 UNION ALL SELECT 'not null: author', 0
      UNION ALL SELECT 'not null: content', count(*) FILTER (l_returnflag = 'N') FROM lineitem
      UNION ALL SELECT 'not null: create_date', 0
      UNION ALL SELECT 'length <= 255: post_id', 0 UNION ALL SELECT 'length <= 255: comment_id', 0
      UNION ALL SELECT 'length <= 255: author', count(*) FILTER (l_suppkey > 5) FROM lineitem
      UNION ALL SELECT 'length <= 65535: content', 0
      UNION ALL SELECT 'unique: post_id, comment_id', count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem)""",
)
def _(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("post_id"),
        F.col("l_linenumber").cast("string").alias("comment_id"),
        F.when(F.col("l_suppkey") > 5, F.repeat(F.lit("x"), 256)).otherwise("x").alias("author"),
        F.nullif("l_returnflag", F.lit("N")).alias("content"),
        F.to_date("l_shipdate").alias("create_date"),
    )
    return quality.constraint_report(rows, MART["tb_comments"])


@query(
    "json_violations",
    """SELECT doc_id, 'root.like_count' AS path, 'int' AS expected, 'string' AS found FROM documents WHERE lang = 'de'
    UNION ALL SELECT doc_id, 'root.dislike_count', 'int', 'missing' FROM documents WHERE lang = 'es'
    UNION ALL SELECT doc_id, 'root.title', 'str', 'void' FROM documents WHERE source = 'src3'
    UNION ALL SELECT doc_id, 'root.comments[' || pos || '].comment_date', 'int', 'string' FROM
      (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents
        WHERE contains(text, chr(10)) OR lang <> 'fr')
      WHERE length(line) > 900
    UNION ALL SELECT doc_id, 'root.comments', 'list', 'string' FROM documents WHERE NOT contains(text, chr(10)) AND lang = 'fr'
    UNION ALL SELECT doc_id, 'root', 'dict', 'missing' FROM documents WHERE false""",
)
def _(spark, folder):
    """Documents as JSON with wrong types, missing keys and nulls, checked at every depth."""
    d = table(spark, folder, "documents")

    def comment(line):
        long = F.length(line) > 900
        return F.concat(
            F.lit('{"comment_nickname":"n","comment_content":'), F.to_json(F.array(line)).substr(F.lit(2), F.length(F.to_json(F.array(line))) - 2),
            F.lit(',"comment_like_count":1,"comment_dislike_count":0,"comment_date":'),
            F.when(long, F.lit('"late"')).otherwise(F.lit("12")), F.lit("}"),
        )

    lines = F.split("text", "\n")
    comments = F.when((F.size(lines) == 1) & (F.col("lang") == "fr"), F.lit('"none"')).otherwise(
        F.concat(F.lit("["), F.array_join(F.transform(lines, comment), ","), F.lit("]"))
    )
    json = F.concat(
        F.lit('{"car_name":"c","id":"i","nickname":"n","article":"a","view_count":1,"date":1,"comment_count":1,"more":[1],"source":"'),
        "source",
        F.lit('","title":'), F.when(F.col("source") == "src3", "null").otherwise('"t"'),
        F.when(F.col("lang") == "es", "").otherwise(',"dislike_count":0'),
        F.lit(',"like_count":'), F.when(F.col("lang") == "de", '"7"').otherwise("7"),
        F.lit(',"comments":'), comments, F.lit("}"),
    )
    return quality.json_violations(d.select("doc_id", json.alias("json")), "json", RAW, ["doc_id"])
