"""Stored pages and API records -> unified post records and work lists.

A page table has ``url`` and ``html``. Every extractor adds ``status``: ``ok``,
``deleted`` (the post is gone) or ``failed`` (a required part did not parse),
so good rows and retry rows come out of one pass.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmart.functions import markup as M
from talkmart.functions.keys import path_id, query_id
from talkmart.functions.once import computed_once, let
from talkmart.functions.numbers import or_default, parse_count, token
from talkmart.functions.timefn import (
    DASH,
    DOT_LONG,
    DOT_SHORT,
    ISO_Z,
    SEOUL,
    before_marker,
    parse_epoch,
    parse_short_date,
    within_lookback,
)
from talkmart.schemas import RAW

_COMMENTS = RAW["comments"].dataType.simpleString()


_PART = "\u0002"


def _finish(df: DataFrame, car_name: str | Column, source: str) -> DataFrame:
    car = car_name if isinstance(car_name, Column) else F.lit(car_name)
    ready = df.withColumns({"car_name": car, "source": F.lit(source)})
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW.fields]
    return ready.select("url", *fields, "status")


def _comment(content, nickname, day, likes, dislikes) -> Column:
    return F.struct(
        content.alias("comment_content"),
        nickname.alias("comment_nickname"),
        day.cast("int").alias("comment_date"),
        likes.alias("comment_like_count"),
        dislikes.alias("comment_dislike_count"),
    )


def _decoded(comments: Column) -> Column:
    """Decode the entities in text and name of every comment; one call per page."""
    texts = F.transform(
        comments,
        lambda c: F.concat_ws(
            _PART, F.coalesce(c["comment_content"], F.lit("")), F.coalesce(c["comment_nickname"], F.lit(""))
        ),
    )

    def put_back(parts: Column) -> Column:
        return F.transform(
            comments,
            lambda c, i: _comment(
                F.when(c["comment_content"].isNotNull(), F.get(parts, i * 2)),
                F.when(c["comment_nickname"].isNotNull(), F.get(parts, i * 2 + 1)),
                c["comment_date"],
                c["comment_like_count"],
                c["comment_dislike_count"],
            ),
        )

    return let(F.split(M.decode_entities(F.array_join(texts, _PART)), _PART), put_back).cast(_COMMENTS)


def _any_missing(*columns: str) -> Column:
    return F.greatest(*(F.col(c).isNull() for c in columns)) if len(columns) > 1 else F.col(columns[0]).isNull()


def _any_incomplete(comments: Column, *fields: str) -> Column:
    return F.exists(comments, lambda c: F.array_contains(F.array(*(c[f].isNull() for f in fields)), True))


def profile_pages(pages: DataFrame, car_name: str | Column, source: str = "bobae", zone: str = SEOUL) -> DataFrame:
    """Forum pages with a writer profile and one ``|``-separated count line.

    A page without its comment box, or with a comment that lacks a part or its vote
    box, is ``failed`` and comes again. So is one with a list inside a comment: its
    entries cannot be told from comments. A box without a list has no comments.
    """
    html = F.col("html")

    def comment(item: Column) -> Column:
        head = M.leaf(item, "dt")
        box = M.element(item, "div", "updownbox")
        votes = M.sections(box, "a")

        def vote(n: int) -> Column:
            label = M.text_of(F.split(F.try_element_at(votes, F.lit(n)), "(?i)</a", 2)[0])
            return F.when(box.isNotNull(), parse_count(F.try_element_at(F.split(label, " "), F.lit(2))))

        return _comment(
            M.text_of(M.leaf(item, "dd")),
            M.text_of(M.element(head, "span", "author")),
            parse_epoch(M.text_of(M.element(head, "span", "date")), DOT_SHORT, zone=zone),
            vote(1),
            vote(2),
        )

    comment_box = M.element(html, "div", "commentlistbox")
    items = M.sections(M.element(comment_box, "ul", "basiclist"), "li")
    boxes = {
        "profile": M.element(html, "div", "writerProfile"),
        "body": let(
            M.element(html, "div", "content02"),
            lambda box: F.coalesce(M.element(box, "div", "bodyCont"), M.element(box, "div", "mycarCont")),
        ),
        "counts": M.text_of(M.element(html, "span", "countGroup")),
        "boxless": comment_box.isNull(),
        "comments": F.coalesce(F.transform(items, comment), F.array()).cast(_COMMENTS),
    }
    counts, profile = F.col("counts"), F.col("profile")
    stamp = F.regexp_replace(token(counts, ("|", -1)), "&nbsp;?|\u00a0", " ")
    fields = {
        "title": M.attribute(profile, "dt", "title"),
        "nickname": or_default(M.text_of(M.leaf(profile, "a", "nickName")), ""),
        "article": M.broken_text(F.col("body")),
        "view_count": parse_count(token(counts, ("|", 0), (" ", 1))),
        "like_count": parse_count(token(counts, ("|", 1), (" ", 2))),
        "date": parse_epoch(F.concat_ws(" ", token(stamp, (" ", 0)), token(stamp, (" ", 2))), DOT_LONG, zone=zone),
        "deleted": profile.isNull(),
    }
    found = computed_once(computed_once(pages, ["url"], boxes), ["url", "comments", "boxless"], fields)
    parts = ("comment_content", "comment_nickname", "comment_date", "comment_like_count")
    bad = _any_missing("title", "article", "date") | _any_incomplete(F.col("comments"), *parts) | F.col("boxless")
    parsed = found.select(
        "url",
        F.concat(F.lit(source + "_"), query_id(F.col("url"))).alias("id"),
        M.decode_entities("title").alias("title"),
        M.decode_entities("nickname").alias("nickname"),
        M.joined_lines(M.decode_entities("article")).alias("article"),
        "view_count",
        "like_count",
        F.lit(0).alias("dislike_count"),
        "date",
        F.size("comments").alias("comment_count"),
        _decoded(F.col("comments")).alias("comments"),
        F.when(F.col("deleted"), "deleted").when(bad, "failed").otherwise("ok").alias("status"),
    )
    return _finish(parsed, car_name, source)


def view_pages(pages: DataFrame, car_name: str | Column, source: str = "clien", zone: str = SEOUL) -> DataFrame:
    """Forum pages with a content view, one block per field and comment rows."""

    def named(container: Column, tag: str, css_class: str) -> Column:
        return M.strip(M.text_of(M.leaf(container, tag, css_class)))

    def comment(row: Column) -> Column:
        info = M.element(row, "div", "comment_info")
        votes = M.strip(M.text_of(M.leaf(M.element(row, "div", "comment_content_symph"), "strong")))
        return _comment(
            M.joined_lines(M.broken_text(M.element(row, "div", "comment_content"))),
            named(info, "span", "nickname"),
            parse_epoch(before_marker(named(info, "span", "timestamp"), "/"), DASH, zone=zone),
            parse_count(votes, None),
            F.lit(0),
        )

    view = M.element(F.col("html"), "div", "content_view")
    boxes = {
        box: M.element(F.col("view"), "div", box)
        for box in ("post_title", "post_author", "post_info", "post_view", "post_comment")
    }
    listed = M.element(F.col("post_comment"), "div", "comment")
    row_start = rf"(?={M.open_tag('div', 'comment_row')})"
    rows = F.filter(
        F.split(F.col("listed"), row_start),
        lambda r: r.rlike(r"(?i)^<div\b[^>]*\bcomment_row\b") & ~r.rlike(r"(?i)^<div\b[^>]*[\s\"']blocked[\s\"']"),
    )
    title_box = F.col("post_title")
    # The title is the first span without a class.
    plain_span = F.regexp_extract(
        M.leaf(title_box, "h3", "post_subject"), r"(?is)<span(?![^>]*\bclass\b)[^>]*>(.*?)</span", 1
    )
    likes = let(
        M.element(title_box, "a", "post_symph"),
        lambda symph: F.when(symph.isNull(), "0").otherwise(M.text_of(M.leaf(symph, "span"))),
    )
    said = M.leaf(M.element(F.col("post_comment"), "div", "comment_head"), "strong")
    fields = {
        "title": M.strip(M.text_of(plain_span)),
        "nickname": named(F.col("post_info"), "span", "nickname"),
        "article": M.broken_text(M.element(F.col("post_view"), "div", "post_article")),
        "like_count": parse_count(likes, None),
        "view_count": parse_count(named(F.col("post_author"), "span", "view_count"), None),
        "date": parse_epoch(
            before_marker(named(F.col("post_author"), "span", "date"), "\n"), DASH, zone=zone
        ),
        "comment_count": parse_count(M.strip(M.text_of(said)), None),
        "listed": listed,
    }
    found = computed_once(pages, ["url"], {"view": view})
    found = computed_once(found, ["url"], boxes)
    found = computed_once(found, ["url"], fields)
    kept = ["url", *(f for f in fields if f != "listed")]
    found = computed_once(
        found,
        [*kept, "listed"],
        {"comments": F.coalesce(F.transform(rows, comment), F.array()).cast(_COMMENTS)},
    )
    bad = _any_missing(*fields) | _any_incomplete(
        F.col("comments"), "comment_content", "comment_nickname", "comment_date", "comment_like_count"
    )
    parsed = found.select(
        "url",
        F.concat(F.lit(source + "_"), path_id(F.col("url"))).alias("id"),
        M.decode_entities("title").alias("title"),
        M.decode_entities("nickname").alias("nickname"),
        M.joined_lines(M.decode_entities("article")).alias("article"),
        "like_count",
        F.lit(0).alias("dislike_count"),
        "view_count",
        "date",
        "comment_count",
        _decoded(F.col("comments")).alias("comments"),
        F.when(bad, "failed").otherwise("ok").alias("status"),
    )
    return _finish(parsed, car_name, source)


def article_pages(pages: DataFrame) -> DataFrame:
    """Plain article pages: title, heading, main text and language."""
    html = F.col("html")
    kept = [c for c in pages.columns if c != "html"]
    fields = {
        "title": M.text_of(M.leaf(html, "title")),
        "heading": M.text_of(M.leaf(html, "h1")),
        "article": M.broken_text(M.element(html, "article")),
        "lang": M.attribute(html, "html", "lang"),
    }
    return computed_once(pages, kept, fields).select(
        *kept,
        M.strip(M.decode_entities("title")).alias("title"),
        M.strip(M.decode_entities("heading")).alias("heading"),
        M.joined_lines(M.decode_entities("article")).alias("article"),
        "lang",
    )


def page_links(pages: DataFrame, container: str = "nav") -> DataFrame:
    """Link targets inside a container element, one row each, in page order."""
    links = M.links_of(M.element(F.col("html"), container))
    kept = [c for c in pages.columns if c != "html"]
    rows = pages.select(*kept, F.posexplode(links).alias("pos", "link"))
    return rows.withColumn("link", M.decode_entities("link"))


def listed_links(pages: DataFrame, day: str | date, layout: str = "short", days: int = 7) -> DataFrame:
    """Distinct links on listing pages whose date lies in the look-back window.

    ``short`` listings mark the date as the second ``next`` span of a list item
    (``25. 01. 30``); ``iso`` listings as a ``timestamp`` span that starts with
    ``yyyy-MM-dd``.
    """
    html = F.col("html")
    if layout == "short":
        items = M.sections(M.leaf(M.element(html, "div", "search_Community"), "ul"), "li")
        spans = M.sections(F.col("item"), "span", "next")
        text = F.split(F.try_element_at(spans, F.lit(2)), "(?i)</span", 2)[0]
        listed = parse_short_date(M.text_of(text))
    elif layout == "iso":
        items = M.sections(M.element(html, "div", "total_search"), "div", "list_item")
        stamp = M.text_of(M.leaf(F.col("item"), "span", "timestamp"))
        listed = F.substring(stamp, 1, 10).try_cast("date")
    else:
        raise ValueError(f"unknown layout: {layout}")
    rows = pages.select(F.explode(items).alias("item"))
    rows = rows.select(M.attribute(F.col("item"), "a", "href").alias("link"), listed.alias("listed_on"))
    recent = rows.filter(within_lookback(F.col("listed_on"), day, days))
    return recent.select(M.decode_entities("link").alias("link")).distinct()


# The parts of a video API record that are used.
API_RECORD = (
    "id string, snippet struct<title: string, channelTitle: string, description: string, publishedAt: string>,"
    " statistics struct<likeCount: string, viewCount: string, commentCount: string>,"
    " comments array<struct<author: string, text: string, votes: string, time_parsed: double>>"
)


def api_records(records: DataFrame, car_name: str | Column, column: str = "json", source: str = "youtube") -> DataFrame:
    """Video API records (JSON text) -> unified records.

    Missing texts become empty, missing counts 0; a count that is there but is no
    number, or a comment without time, makes the record ``failed``.
    """

    def count(value: Column) -> Column:
        return F.when(value.isNull(), 0).otherwise(value.try_cast("int"))

    parsed_json = computed_once(records, [], {"r": F.from_json(column, API_RECORD)})
    replies = F.transform(
        F.coalesce(F.col("r.comments"), F.array()),
        lambda c: _comment(
            or_default(c["text"], ""),
            or_default(c["author"], ""),
            F.floor(c["time_parsed"]),
            count(c["votes"]),
            F.lit(0),
        ),
    )
    parsed = parsed_json.select(
        F.col("r.id").alias("url"),
        F.concat(F.lit(source + "_"), F.col("r.id")).alias("id"),
        or_default(F.col("r.snippet.title"), "").alias("title"),
        or_default(F.col("r.snippet.channelTitle"), "").alias("nickname"),
        or_default(F.col("r.snippet.description"), "").alias("article"),
        count(F.col("r.statistics.likeCount")).alias("like_count"),
        count(F.col("r.statistics.viewCount")).alias("view_count"),
        F.lit(0).alias("dislike_count"),
        parse_epoch(or_default(F.col("r.snippet.publishedAt"), ""), ISO_Z, zone="UTC").alias("date"),
        count(F.col("r.statistics.commentCount")).alias("comment_count"),
        replies.cast(_COMMENTS).alias("comments"),
    )
    bad = _any_missing("id", "like_count", "view_count", "comment_count") | _any_incomplete(
        F.col("comments"), "comment_date", "comment_like_count"
    )
    judged = parsed.withColumn("status", F.when(bad, "failed").otherwise("ok"))
    return _finish(judged, car_name, source)


def usable(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("status") == "ok").select(*RAW.fieldNames())


def to_retry(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("status") == "failed").select("url")
