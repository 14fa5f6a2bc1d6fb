"""Civil days, look-back windows, date and count parsing, work lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkmart.functions import timefn as D
from talkmart.functions.numbers import or_default, parse_count, token
from talkmart.operators import aliases, selection
from talkmart.plans.queries import shapes as S
from talkmart.plans.queries.registry import query, sql_bucket, sql_epoch, table


def _events(spark, folder):
    return table(spark, folder, "events").withColumn("create_timestamp", D.to_epoch(F.col("ts")))


_EVENTS = f"(SELECT *, {sql_epoch('ts')} AS create_timestamp FROM events)"


@query(
    "day_window_kst",
    f"""SELECT event_id, create_timestamp FROM {_EVENTS}
    WHERE create_timestamp BETWEEN 1704898800 AND 1704985199""",
)
def _(spark, folder):
    rows = _events(spark, folder).filter(D.between_days(F.col("ts"), "2024-01-11"))
    return rows.select("event_id", "create_timestamp")


@query(
    "lookback_7d",
    "SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) BETWEEN '2024-01-13' AND '2024-01-20'",
)
def _(spark, folder):
    rows = table(spark, folder, "events").select("event_id", F.to_date("ts").alias("day"))
    return rows.filter(D.within_lookback(F.col("day"), "2024-01-20"))


@query(
    "month_window",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
      CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS next_month
    FROM orders WHERE o_orderdate + INTERVAL 9 HOUR >= '1996-12-01' AND o_orderdate + INTERVAL 9 HOUR < '1997-01-01'""",
)
def _(spark, folder):
    orders = table(spark, folder, "orders")
    kept = orders.filter(D.in_month(F.col("o_orderdate"), "1996-12-15"))
    day = F.to_date("o_orderdate")
    return kept.select(
        "o_orderkey", day.alias("day"), F.add_months(F.trunc(day, "month"), 1).alias("next_month")
    )


@query(
    "backfill_days",
    f"""SELECT dt, event_type, count(*) AS rows FROM (SELECT {S.sql_seoul_day('create_timestamp')} AS dt, event_type
      FROM {_EVENTS}) WHERE dt BETWEEN '2024-01-08' AND '2024-01-19' GROUP BY dt, event_type""",
)
def _(spark, folder):
    """A range of days in one job, every day and group at once."""
    when = F.col("create_timestamp")
    rows = _events(spark, folder).filter(D.between_days(F.col("ts"), "2024-01-08", "2024-01-19"))
    return rows.groupBy(D.to_local_date(when).alias("dt"), "event_type").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "epoch_to_seoul_date",
    f"""SELECT event_id, {S.sql_seoul_day('create_timestamp')} AS create_date,
      strftime(make_timestamp((create_timestamp + 32400) * 1000000), '%Y/%m/%d') AS day_path FROM {_EVENTS}""",
)
def _(spark, folder):
    day = D.to_local_date(F.col("create_timestamp"))
    return _events(spark, folder).select(
        "event_id", day.alias("create_date"), F.concat_ws("/", *D.day_parts(day)).alias("day_path")
    )


@query(
    "epoch_to_seoul_sql",
    f"""SELECT event_type, {S.sql_seoul_day('create_timestamp')} AS create_date, count(*) AS rows
    FROM {_EVENTS} GROUP BY ALL""",
)
def _(spark, folder):
    """The same conversion through the registered SQL function."""
    D.register_sql_functions(spark)
    day = F.expr("CAST(convert_unix_ts_to_seoul(create_timestamp) AS DATE)")
    return _events(spark, folder).groupBy("event_type", day.alias("create_date")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "parse_dates",
    f"""SELECT event_id, secs - secs % 60 - 32400 AS dot_long, secs - secs % 60 - 32400 AS dot_short,
      secs - 32400 AS dash, secs AS iso, CAST(NULL AS BIGINT) AS broken
    FROM (SELECT event_id, {sql_epoch('ts')} AS secs FROM events)""",
)
def _(spark, folder):
    """Every layout, written from the event time and read back."""
    ts = F.col("ts")
    rows = table(spark, folder, "events").select(
        "event_id",
        F.date_format(ts, "yyyy.MM.dd HH:mm").alias("dot_long"),
        F.date_format(ts, "yy.MM.dd HH:mm").alias("dot_short"),
        F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" / edited")).alias("dash"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"),
        F.col("event_type").alias("broken"),
    )
    either = (D.DOT_LONG, D.DOT_SHORT)
    return rows.select(
        "event_id",
        D.parse_epoch(F.col("dot_long"), *either).alias("dot_long"),
        D.parse_epoch(F.col("dot_short"), *either).alias("dot_short"),
        D.parse_epoch(D.before_marker(F.col("dash"), "/"), D.DASH).alias("dash"),
        D.parse_epoch(F.col("iso"), D.ISO_Z, zone="UTC").alias("iso"),
        D.parse_epoch(F.col("broken"), *either, D.DASH).alias("broken"),
    )


@query("short_dates", "SELECT o_orderkey, make_date(2000 + o_orderkey % 30, month(o_orderdate), day(o_orderdate)) AS day FROM orders WHERE NOT (month(o_orderdate) = 2 AND day(o_orderdate) = 29) UNION ALL SELECT o_orderkey, CASE WHEN (o_orderkey % 30) % 4 = 0 THEN make_date(2000 + o_orderkey % 30, 2, 29) END FROM orders WHERE month(o_orderdate) = 2 AND day(o_orderdate) = 29")
def _(spark, folder):
    """``yy. MM. dd`` texts; a 29 February of a common year is no date."""
    year = F.lpad(F.pmod("o_orderkey", F.lit(30)).cast("string"), 2, "0")
    text = F.concat(year, F.date_format("o_orderdate", "'. 'MM'. 'dd"))
    return table(spark, folder, "orders").select("o_orderkey", D.parse_short_date(text).alias("day"))


@query(
    "parse_counts",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_extendedprice) AS INTEGER) AS views,
      CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 0 ELSE CAST(l_partkey AS INTEGER) END AS likes,
      CASE l_returnflag WHEN 'A' THEN NULL WHEN 'N' THEN NULL ELSE CAST(l_partkey AS INTEGER) END AS strict_likes,
      strftime(l_shipdate, '%H:%M') AS clock, coalesce(nullif(l_returnflag, 'N'), '') AS flag
    FROM lineitem""",
)
def _(spark, folder):
    """Counts and tokens out of one ``views | likes | date`` display line."""
    likes = F.when(F.col("l_returnflag") == "A", "-").when(F.col("l_returnflag") == "N", "").otherwise(
        F.format_number("l_partkey", 0)
    )
    line = F.concat_ws(
        " | ",
        F.concat(F.lit("조회 "), F.format_number(F.floor("l_extendedprice"), 0)),
        F.concat(F.lit("추천 수 "), likes),
        F.date_format("l_shipdate", "yyyy.MM.dd '(x)' HH:mm"),
    )
    rows = table(spark, folder, "lineitem").withColumn("line", line)
    liked = token(F.col("line"), ("|", 1), (" ", 2))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        parse_count(token(F.col("line"), ("|", 0), (" ", 1))).alias("views"),
        parse_count(liked).alias("likes"),
        parse_count(liked, None).alias("strict_likes"),
        token(F.col("line"), ("|", -1), (" ", 2)).alias("clock"),
        or_default(F.nullif("l_returnflag", F.lit("N")), "").alias("flag"),
    )


_WORDS = {"Red": "red,hot", "Cold": "cold, blue", "Ring": "ring", "Gone": "missing"}


@query(
    "alias_tag",
    """SELECT p_partkey, p_name, label FROM part CROSS JOIN
      (VALUES ('Red', 'red|hot'), ('Cold', 'cold|blue'), ('Ring', 'ring'), ('Gone', 'missing')) a(label, words)
    WHERE regexp_matches(p_name, words)""",
)
def _(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    return selection.tag_by_alias(parts, "p_name", _WORDS, "label")


@query(
    "alias_table_tag",
    """SELECT DISTINCT doc_id, p_brand FROM documents JOIN
      (SELECT DISTINCT p_brand, trim(unnest(string_split(p_name, ' '))) AS alias FROM part) a
      ON contains(text, a.alias) WHERE a.alias <> ''""",
)
def _(spark, folder):
    words = F.explode(F.split("p_name", " "))
    names = table(spark, folder, "part").select(F.col("p_brand").alias("label"), words.alias("alias"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counts = aliases.pair_counts(docs, "text", aliases.clean_aliases(names))
    return aliases.tag_by_alias_table(docs, "text", names, "p_brand", counts).select("doc_id", "p_brand").distinct()


@query(
    "allowed_sources",
    "SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src4', 'src9')",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return selection.only_sources(docs, ("src1", "src4", "src9"))


@query("distinct_targets", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(spark, folder):
    return selection.distinct_ids(table(spark, folder, "lineitem"), "l_partkey", "l_suppkey")


@query(
    "top_viewed_per_keyword",
    """SELECT source, doc_id, n_chars, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY source
      ORDER BY n_chars DESC, doc_id) AS INTEGER) AS rank FROM documents) WHERE rank <= 50""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select("source", "doc_id", "n_chars")
    return selection.top_per_group(docs, ["source"], [F.col("n_chars").desc(), F.col("doc_id")], 50)


@query(
    "stride_shards",
    """SELECT o_custkey, position, CAST(position % 10 AS INTEGER) AS shard FROM (SELECT o_custkey,
      row_number() OVER (ORDER BY md5(CAST(o_custkey AS VARCHAR)), o_custkey) - 1 AS position
      FROM (SELECT DISTINCT o_custkey FROM orders))""",
)
def _(spark, folder):
    return selection.stride_shards(table(spark, folder, "orders"), "o_custkey", 10)


@query("hash_shards", f"SELECT o_orderkey, {sql_bucket('o_orderkey', 10)} AS shard FROM orders")
def _(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", selection.hash_shard(F.col("o_orderkey"), 10).alias("shard"))


@query(
    "validation_sample",
    "SELECT doc_id, lang, n_chars FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 10",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return selection.validation_sample(docs, "doc_id", 10)
