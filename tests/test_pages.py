"""Page extractors on small pages with awkward parts."""

from __future__ import annotations

from talkmart.functions import markup as M
from talkmart.operators import pages as P

PROFILE = """<div class="writerProfile"><dl><dt title="It&#39;s a &quot;title&quot;">x</dt>
<dd><span class="countGroup">조회 1,234 | 추천 수 5 | 2025.01.30 (목) 11:22</span></dd></dl></div>
<div class="content02"><div class="bodyCont"><p>one</p><div>two &lt;b&gt;</div> three </div></div>
<div class="commentlistbox"><ul class="basiclist">{comments}</ul></div>"""
COMMENT = """<li><dl><dt><span class="author">{who}</span><span class="date">{when}</span></dt><dd>{text}</dd></dl>
<div class="updownbox"><a>추천 1,002</a><a>반대 x</a></div></li>"""


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "url string, html string")


def test_profile_page(spark):
    comments = COMMENT.format(who="a&amp;b", when="25.01.30 12:00", text="hi <b>you</b>")
    df = frame(
        spark,
        ("/view?No=7", PROFILE.format(comments=comments)),
        ("/view?No=8", "<html>gone</html>"),
        ("/view?No=9", PROFILE.format(comments=COMMENT.format(who="a", when="yesterday", text="x"))),
        ("/view?No=10", PROFILE.format(comments="").replace("2025.01.30", "2025-01-30")),
        ("/view?No=11", PROFILE.format(comments="").replace("commentlistbox", "x")),
        ("/view?No=12", PROFILE.format(comments=COMMENT.format(who="a", when="25.01.30 12:00", text="x").replace("updownbox", "x"))),
        ("/view?No=13", PROFILE.format(comments=2 * COMMENT.format(who="a", when="25.01.30 12:00", text="<ul><li>p</li></ul>"))),
        ("/view?No=14", PROFILE.format(comments=2 * COMMENT.format(who="<span>[lv]</span> name", when="25.01.30 12:00", text="x"))),
    )
    rows = {r.url: r for r in P.profile_pages(df, "Kona").collect()}
    assert {u: r.status for u, r in rows.items()} == {
        "/view?No=7": "ok", "/view?No=8": "deleted", "/view?No=9": "failed", "/view?No=10": "failed",
        "/view?No=11": "failed", "/view?No=12": "failed", "/view?No=13": "failed", "/view?No=14": "ok",
    }
    assert [c.comment_nickname for c in rows["/view?No=14"].comments] == ["[lv] name"] * 2
    post = rows["/view?No=7"]
    assert (post.id, post.title, post.nickname, post.source) == ("bobae_7", "It's a \"title\"", "", "bobae")
    assert post.article == "one\ntwo <b>\nthree"
    assert (post.view_count, post.like_count, post.dislike_count, post.comment_count) == (1234, 5, 0, 1)
    assert post.date == 1738203720
    comment = post.comments[0]
    assert (comment.comment_content, comment.comment_nickname) == ("hi you", "a&b")
    assert (comment.comment_like_count, comment.comment_dislike_count) == (1002, 0)
    extracted = P.profile_pages(df, "Kona")
    assert [r.url for r in P.to_retry(extracted).orderBy("url").collect()] == [f"/view?No={n}" for n in (10, 11, 12, 13, 9)]
    assert P.usable(extracted).count() == 2


VIEW = """<div class="content_view"><div class="post_title"><h3 class="post_subject"><span class="c">cat</span><span> T &amp; t </span></h3>
{symph}</div><div class="post_author"><span class="view_count">2,000</span><span class="date">2025-01-30 01:02:03
 edited</span></div><div class="post_info"><span class="nickname"> nick </span></div>
<div class="post_view"><div class="post_article"><p>a</p><script>no</script><p>b&nbsp;</p></div></div>
<div class="post_comment"><div class="comment_head"><strong>{count}</strong></div><div class="comment">{rows}</div></div></div>"""
ROW = """<div class="comment_row {css}"><div class="comment_info"><span class="nickname">n</span>
<span class="timestamp">2025-01-30 02:00:00 / 2025-01-31 00:00:00</span></div><div class="comment_content_symph"><strong>{votes}</strong></div>
<div class="comment_content"><div>x<br>y</div></div></div>"""


def test_view_page(spark):
    ok = VIEW.format(symph='<a class="post_symph"><span>3</span></a>', count="1,000", rows=ROW.format(css="", votes="2") + ROW.format(css="blocked", votes="-"))
    df = frame(
        spark,
        ("https://h/b/5?x=1", ok),
        ("https://h/b/6", VIEW.format(symph="", count="0", rows="")),
        ("https://h/b/7", VIEW.format(symph="", count="many", rows="")),
        ("https://h/b/8", VIEW.format(symph="", count="1", rows=ROW.format(css="", votes="none"))),
        ("https://h/b/9", "<p>gone</p>"),
    )
    rows = {r.id: r for r in P.view_pages(df, "Kona").collect()}
    assert {i: r.status for i, r in rows.items()} == {
        "clien_5": "ok", "clien_6": "ok", "clien_7": "failed", "clien_8": "failed", "clien_9": "failed",
    }
    post = rows["clien_5"]
    assert (post.title, post.nickname, post.article) == ("T & t", "nick", "a\nb")
    assert (post.like_count, post.view_count, post.comment_count, post.date) == (3, 2000, 1000, 1738166523)
    assert [(c.comment_content, c.comment_like_count) for c in post.comments] == [("x\ny", 2)]
    assert rows["clien_6"].like_count == 0 and rows["clien_6"].comments == []


def test_api_record(spark):
    full = '{"id":"v","snippet":{"title":"t","publishedAt":"2025-01-30T01:02:03Z"},"statistics":{"likeCount":"5"},"comments":[{"text":"c","votes":"2","time_parsed":1.9}]}'
    df = spark.createDataFrame([(full,), ('{"id":"w","statistics":{"viewCount":"x"}}',), ("junk",)], "json string")
    rows = {r.url: r for r in P.api_records(df, "Kona").collect()}
    assert rows["v"].status == "ok" and rows["v"].date == 1738198923
    assert (rows["v"].nickname, rows["v"].view_count, rows["v"].like_count) == ("", 0, 5)
    assert rows["v"].comments[0].comment_date == 1
    assert rows["w"].status == "failed" and rows[None].status == "failed"


def test_links(spark):
    html = '<div class="search_Community"><ul><li><a href="/a?x=1&amp;y=2">t</a><span class="next">u</span><span class="next">25. 01. 30</span></li></ul></div>'
    rows = P.listed_links(frame(spark, ("l", html), ("m", html)), "2025-01-31").collect()
    assert [r.link for r in rows] == ["/a?x=1&y=2"]
    assert P.listed_links(frame(spark, ("l", html)), "2025-03-01").count() == 0


def test_entities_are_decoded_a_few_rows_at_a_time(spark):
    """An Arrow batch would hold the texts of 10,000 pages at once."""
    df = spark.createDataFrame([("a &amp; b &lt;3",), ("&#48;&nbsp;&unknown;",), ("",), (None,)], "text string")
    decoded = df.select(M.decode_entities("text").alias("text"))
    assert [r.text for r in decoded.collect()] == ["a & b <3", "0\u00a0&unknown;", "", None]
    assert "ArrowEvalPython" not in decoded._jdf.queryExecution().executedPlan().toString()
