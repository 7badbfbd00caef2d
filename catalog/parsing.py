"""Landed bodies to article rows. Pages come from the tables; forum pages are built from them, one per row."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, ts
from catalog.columns import _BADGE
from catalog.landing import text
from moodtide import config
from moodtide.functions import urls
from moodtide.plans import repair
from moodtide.sources import parsers
from moodtide.sources.domain import Desk, epoch_seconds

c = F.col


def escaped(col):
    return F.replace(F.replace(F.replace(col, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


# -- forum pages --------------------------------------------------------------------------------
def list_pages(desk: Desk):
    """A list page per event: one post (some announcements) and one deleted entry."""
    title = text(F.when(c("value") >= 200, "[公告]").otherwise("[標的]"), " ", c("event_type"), " &amp; ", c("user_id"))
    entry = text('<div class="r-ent"><div class="nrec"><span class="hl f2">', F.expr(_BADGE), '</span></div><div class="title">\n\t<a href="',
                 "/bbs/Stock/M.", epoch_seconds(c("ts")), '.A.1F.html">', title, '</a>\n</div><div class="meta"><div class="author"> ',
                 c("user_id"), " </div></div></div>")
    gone = text('<div class="r-ent"><div class="nrec"></div><div class="title">(本文已被刪除) [', c("user_id"),
                ']</div><div class="meta"><div class="author">-</div></div></div>')
    return desk.spread("events").select("event_id", text("<html><body><div class='r-list-container action-bar-margin'>", entry, gone,
                                                        "</div></body></html>").alias("body"))


@query("parse_forum_list", f"""
 SELECT event_id, '[標的] ' || event_type || ' & ' || user_id AS title,
  'https://www.ptt.cc/bbs/Stock/M.' || CAST(floor(epoch(ts)) AS BIGINT) || '.A.1F.html' AS url, CAST(user_id AS VARCHAR) AS author,
  CAST(CASE WHEN t = '爆' THEN 100 WHEN t = 'XX' THEN -100 WHEN t = '' THEN 0 WHEN regexp_matches(t, '^X[0-9]+$') THEN CAST(substr(t, 2) AS BIGINT) * -10
    WHEN regexp_matches(t, '^[0-9]+$') THEN CAST(t AS BIGINT) END AS BIGINT) AS push_count,
  {ts("make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000)")} AS published_at
 FROM (SELECT *, trim({_BADGE.replace('STRING', 'VARCHAR')}) AS t FROM events WHERE value < 200)""")
def parse_forum_list(desk: Desk):
    return parsers.forum_list(list_pages(desk), keep=("event_id",))


def post_pages(desk: Desk):
    """A post page per conversation turn, with head lines, a quote, a link, a system line and two comments."""
    head = text('<div class="article-metaline"><span class="article-meta-tag">作者</span><span class="article-meta-value">', c("role"),
                "</span></div>")
    tail = text("\n: quoted ", c("role"), "\n※ 引述《x》之銘言\nhttps://a.example/c\n<span class=\"f2\">※ 發信站: x</span>\n")
    push = text('<div class="push"><span class="hl push-tag">推 </span><span class="f3 hl push-userid">', c("role"),
                '</span><span class="f3 push-content">: turn ', c("turn"), "</span></div>")
    cut = text('<div class="push"><span class="push-tag">→ </span><span class="push-userid">x</span></div>')
    return desk.spread("conversations").select("conv_id", "turn", text(
        '<html><body><div id="main-container"><div id="main-content" class="bbs-screen bbs-content">', head, escaped(c("text")), tail, push, cut,
        "</div></div><div>outside</div></body></html>").alias("body"))


@query("parse_forum_article", """
 SELECT conv_id, turn, array_to_string(list_transform(list_filter(string_split(trim(text, ' ' || chr(10) || chr(9) || chr(13)), chr(10)),
   lambda x: trim(x) <> ''), lambda x: trim(x)), chr(10)) AS content, role AS author, '推' AS push_tag, ': turn ' || turn AS message
 FROM conversations""")
def parse_forum_article(desk: Desk):
    parsed = parsers.forum_article(post_pages(desk), keep=("conv_id", "turn"))
    return parsed.select("conv_id", "turn", "content", F.inline("comments"))


# -- news pages -----------------------------------------------------------------------------------
def landed_pages(desk: Desk):
    """The web pages, some of them with publisher's meta data in the places publishers use."""
    minute = F.lpad((c("page_id") % 60).cast("string"), 2, "0")
    head = lambda tag: F.replace("html", F.lit("<head>"), text("<head>", tag))
    og = text('<meta property="og:title" content=" OG ', c("page_id"), ' &amp; co "><meta property="article:published_time" content="2024-03-05T10:',
              minute, ':12+08:00">')
    ld_list = text('<script type="application/ld+json">[{"a":1},{"datePublished":"2023-05-06T07:', minute, ':09Z"}]</script>')
    ld_one = text('<script type="application/ld+json">{"datePublished":"2023-07-08T09:', minute, ':11"}</script>')
    clock = F.replace("html", F.lit("<article>"), text('<article><time datetime="2022-01-02 03:', minute, ':05">x</time>'))
    html = (F.when(c("url").contains("utm_source"), head(og)).when(c("url").contains("ref=x"), head(ld_list))
            .when(c("url").endswith(".html"), head(ld_one)).when(c("url").contains("#top"), clock).otherwise(c("html")))
    stamp = F.date_format(F.timestamp_seconds(F.lit(1420070400) + c("page_id") * 3600), "yyyyMMddHHmmss")
    return desk.spread("pages").select("page_id", "url", html.alias("raw_html"), stamp.alias("timestamp"), c("url").alias("original"))


def _clean(x: str) -> str:
    """Character references; the semicolon may be missing where a text was cut."""
    for entity, char in (("&lt", "<"), ("&gt", ">"), ("&quot", '"'), ("&#x27", "''"), ("&#39", "''"), ("&amp", "&")):
        x = f"regexp_replace({x}, '{entity};?', '{char}', 'g')"
    return x


_PIECES = lambda x: (f"array_to_string(list_filter(list_transform(string_split_regex({x}, '<[^>]*>'), lambda y: "
                     f"trim({_clean('y')}, ' ' || chr(10) || chr(9))), lambda y: y <> ''), '')")
# A paragraph that is never closed runs to the end of the article, over all paragraphs after it.
_CONTENT = f"""(SELECT page_id, string_agg(own, chr(10) ORDER BY k) FILTER (WHERE own <> '') AS content FROM (
   SELECT page_id, k, CASE WHEN contains(segs[k], '</p>') THEN {_PIECES("split_part(segs[k], '</p>', 1)")}
     ELSE array_to_string(list_transform(segs[k:], lambda s: {_PIECES("s")}), '') END AS own
   FROM (SELECT page_id, string_split(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<p>')[2:] AS segs FROM pages),
        LATERAL (SELECT unnest(range(1, len(segs) + 1)) AS k)) GROUP BY 1)"""
_H1 = _PIECES("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")
_TITLE = _PIECES("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")
_MIN = "lpad(CAST(page_id % 60 AS VARCHAR), 2, '0')"
_OG = "contains(url, 'utm_source')"


def _when(og: str | None, ld_list: str | None, ld_one: str | None, clock: str | None, other: str | None) -> str:
    text_ = lambda x: "NULL" if x is None else f"CAST({x} AS TIMESTAMP)"
    return (f"CASE WHEN {_OG} THEN {text_(og)} WHEN contains(url, 'ref=x') THEN {text_(ld_list)} WHEN url LIKE '%.html' THEN {text_(ld_one)} "
            f"WHEN contains(url, '#top') THEN {text_(clock)} ELSE {text_(other)} END")


_OG_AT, _LIST_AT = f"'2024-03-05 10:' || {_MIN} || ':12'", f"'2023-05-06 07:' || {_MIN} || ':09'"
_ONE_AT, _CLOCK_AT = f"'2023-07-08 09:' || {_MIN} || ':11'", f"'2022-01-02 03:' || {_MIN} || ':05'"


@query("page_titles", f"SELECT page_id, {_H1} AS h1, {_TITLE} AS title FROM pages")
def page_titles(desk: Desk):
    return parsers.page_titles(desk.spread("pages"), keep=("page_id",))


@query("parse_news_html", f"""
 SELECT p.page_id, CASE WHEN {_OG} THEN 'OG ' || p.page_id || ' & co' ELSE {_H1} END AS title, content,
  {ts(_when(_OG_AT, None, _ONE_AT, None, None))} AS published_at
 FROM pages p JOIN {_CONTENT} x ON x.page_id = p.page_id""".replace("% 60", "% 60").replace(_MIN, _MIN.replace("page_id", "p.page_id")))
def parse_news_html(desk: Desk):
    return parsers.news_page(landed_pages(desk), "cnn", keep=("page_id",))


@query("parse_page_full", f"""
 SELECT p.page_id, CASE WHEN {_OG} THEN 'OG ' || p.page_id || ' & co' ELSE {_TITLE} END AS title, content,
  {ts(_when(_OG_AT, None, None, None, None))} AS published_at
 FROM pages p JOIN {_CONTENT} x ON x.page_id = p.page_id WHERE length(content) >= 50""".replace(_MIN, _MIN.replace("page_id", "p.page_id")))
def parse_page_full(desk: Desk):
    return parsers.full_page(landed_pages(desk), "cnn", keep=("page_id",))


@query("extract_archive", f"""
 SELECT p.page_id, CASE WHEN {_OG} THEN 'OG ' || p.page_id || ' & co' ELSE {_H1} END AS title, content, p.url,
  {ts(_when(_OG_AT, _LIST_AT, _ONE_AT, _CLOCK_AT, "make_timestamp((1420070400 + p.page_id * 3600) * 1000000)"))} AS published_at
 FROM pages p JOIN {_CONTENT} x ON x.page_id = p.page_id WHERE length(content) >= 100""".replace(_MIN, _MIN.replace("page_id", "p.page_id")))
def extract_archive(desk: Desk):
    """The canonical address has its own check; here the original one identifies the row."""
    pages = landed_pages(desk)
    parsed = parsers.archive_page(pages, keep=("page_id",))
    same = pages.select("page_id", urls.canonical_url(c("url")).alias("url"), c("url").alias("address"))
    return parsed.join(same, ["page_id", "url"]).drop("url").withColumnRenamed("address", "url")


# -- model answers -----------------------------------------------------------------------------------
@query("parse_label_response", """
 SELECT article_id, 'positive' AS label, 0.9 AS confidence FROM v_texts WHERE lang = 'en'
 UNION ALL SELECT article_id, 'neutral', 0.0 FROM v_texts WHERE lang = 'fr'""".replace("0.9 AS", "CAST(0.9 AS DOUBLE) AS").replace("0.0 FROM", "CAST(0.0 AS DOUBLE) FROM"))
def parse_label_response(desk: Desk):
    """Fenced JSON, bare JSON, an unknown mood, and text that is no JSON."""
    answer = (F.when(c("lang") == "en", F.lit('```json\n[{"text_index": 0, "sentiment": "Positive", "confidence": 0.9},\n'
                                              ' {"text_index": 5, "sentiment": "neutral"}, {"text_index": "x", "sentiment": "neutral"}]\n```'))
              .when(c("lang") == "fr", F.lit(' [{"text_index": "0", "sentiment": "neutral"}] '))
              .when(c("lang") == "de", F.lit('[{"text_index": 0, "sentiment": "angry", "confidence": 1}]'))
              .otherwise(F.lit("I cannot label this")))
    answers = desk.texts().select(answer.alias("answer"), F.array("article_id").alias("ids"))
    return parsers.label_response(answers, "answer", "ids")


# -- repair ---------------------------------------------------------------------------------------------
def damaged_with_bodies(desk: Desk):
    """Stored articles with lost fields, and the landed bodies of most of them."""
    kind, number, user = c("event_type"), c("event_id"), c("user_id")
    seconds = epoch_seconds(c("ts"))
    forms = {"signup": "https://www.ptt.cc/bbs/Stock/M.", "click": "https://news.cnyes.com/news/id/",
             "view": "https://www.reddit.com/r/stocks/comments/", "purchase": "https://edition.cnn.com/x/", "error": "https://www.wsj.com/articles/"}
    url = F.when(kind == "signup", text("https://www.ptt.cc/bbs/Stock/M.", seconds, ".A.", number, ".html")).otherwise(
        text(config.lookup(kind, forms), number, "/x"))
    events = desk.spread("events").withColumn("url", url)
    ids = {"signup": "1", "click": "2", "view": "3", "purchase": "4", "error": "5"}
    lost = lambda value, low, high: F.when(~c("value").between(low, high), value)
    articles = events.select(
        number.alias("article_id"), config.lookup(kind, ids).cast("int").alias("source_id"), "url",
        lost(F.lit("kept title"), 10, 20).alias("title"), lost(F.lit("kept content"), 15, 25).alias("content"),
        lost(F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), 24, 30).alias("published_at"))

    html = (F.when(kind == "signup", text('<div id="main-content">new body ', user, "\n: quote</div>"))
            .when(kind == "purchase", text('<html><head><meta property="og:title" content="new title"><meta name="publishdate" content="',
                                           F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), '"></head><div class="article__content"><p>new body</p><p>',
                                           user, "</p></div></html>"))
            .when(kind == "error", text("<html><h1>new <i>title</i></h1><article><p>new body ", user, "</p></article></html>")))
    item = F.struct(number.alias("newsId"), F.lit("new title").alias("title"), text("<p>new body ", user, "</p>").alias("content"),
                    seconds.alias("publishAt"))
    other = F.struct((number + 1).alias("newsId"), F.lit("wrong").alias("title"), F.lit("wrong").alias("content"), seconds.alias("publishAt"))
    post = F.struct(F.struct(number.cast("string").alias("id"), F.lit("new title").alias("title"),
                             F.when(c("value") > 18, "[removed]").otherwise(text("new body ", user)).alias("selftext"),
                             seconds.alias("created_utc")).alias("data"))
    json = (F.when(kind == "click", F.to_json(F.struct(F.struct(F.array(other, item).alias("data")).alias("items"))))
            .when(kind == "view", F.to_json(F.struct(F.struct(F.array(post).alias("children")).alias("data")))))
    bodies = events.where("value <= 28").select("url", html.alias("raw_html"), json.alias("raw_json"))
    return articles, bodies


@query("repair_articles", f"""
 SELECT article_id, title, content, {ts("published_at")} AS published_at FROM (
  SELECT event_id AS article_id, v.found AS found,
   CASE WHEN found AND event_type = 'click' THEN 'new title' WHEN found AND event_type IN ('view', 'purchase') THEN 'new title'
        WHEN found AND event_type = 'error' THEN 'newtitle' WHEN value NOT BETWEEN 10 AND 20 THEN 'kept title' END AS title,
   CASE WHEN found AND event_type = 'view' AND value > 18 THEN CASE WHEN value NOT BETWEEN 15 AND 25 THEN 'kept content' END
        WHEN found AND event_type = 'purchase' THEN 'new body' || chr(10) || user_id WHEN found THEN 'new body ' || user_id
        WHEN value NOT BETWEEN 15 AND 25 THEN 'kept content' END AS content,
   CASE WHEN found AND event_type <> 'error' THEN date_trunc('second', ts)
        WHEN value NOT BETWEEN 24 AND 30 THEN TIMESTAMP '2000-01-01 00:00:00' END AS published_at
  FROM events, LATERAL (SELECT value BETWEEN 10 AND 28 AS found) v)""")
def repair_articles(desk: Desk):
    articles, bodies = damaged_with_bodies(desk)
    return repair.repair(articles, desk.sources(), bodies).select("article_id", "title", "content", "published_at")
