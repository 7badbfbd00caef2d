"""Landed bodies to article rows, one distributed job per body kind.

Pages go through ``functions.html.outline`` once; everything after it is a Spark expression. JSON bodies need no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.functions import dates, text, urls
from moodtide.functions.html import Page, attr, html_to_text, is_tag, outline, tag_with_class
from moodtide.functions.once import computed_once
from moodtide.sources import feeds

# --- fixed values: where each publisher keeps its text and dates ---------------------
FORUM_BASE = "https://www.ptt.cc"
NEWS_ITEM_URL = "https://news.cnyes.com/news/id/"
POST_BASE = "https://www.reddit.com"
BODY_CONTAINERS = {
    # source: (tag, attribute, value), first match wins
    "cnn": [("div", "class", "article__content"), ("div", "class", "zn-body__paragraph"),
            ("section", "class", "body-text")],
    "wsj": [("div", "class", "article-content"), ("div", "class", "wsj-snippet-body"),
            ("section", "data-testid", "article-body")],
    "marketwatch": [("div", "class", "article__body"), ("div", "id", "js-article__body"),
                    ("div", "data-testid", "article-body"), ("div", "class", "body")],
}
REPAIR_DATE_METAS = ["article:published_time", "publishdate", "datePublished"]
ARCHIVE_DATE_METAS = ["article:published_time", "pubdate", "date", "DC.date.issued"]
ARCHIVE_CONTAINER = "(?i)article|story|content|body"
FULL_PAGE_MIN, ARCHIVE_MIN = 50, 100
# --------------------------------------------------------------------------------------


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _container(page: Page, source: str | Column) -> Column:
    """First container of the publisher; with a source column each row uses the rules of its own source."""
    def test(tag, attribute, value):
        if attribute == "class":
            return tag_with_class(tag, value)
        return lambda t: (t["tag"] == tag) & (attr(t, attribute) == value)
    first = lambda name: F.coalesce(*[page.first(test(*rule)) for rule in BODY_CONTAINERS[name]])
    if isinstance(source, str):
        return first(source)
    return F.coalesce(*[F.when(source == name, first(name)) for name in BODY_CONTAINERS])


def _article_paragraphs(page: Page, every_article: bool) -> Column:
    """``p`` below the first ``article``, or below any of them."""
    if not every_article:
        return page.inside(page.first(is_tag("article")), is_tag("p"))
    articles = page.all(is_tag("article"))
    return page.all(lambda t: (t["tag"] == "p") & F.exists(
        articles, lambda a: (t["pos"] > a["pos"]) & (t["pos"] < a["stop"])))


def _body_text(page: Page, source: str | Column, every_article: bool, retry_empty: bool) -> Column:
    """Paragraphs of the publisher's container, else of the article element."""
    box = _container(page, source)
    own, fallback = page.inside(box, is_tag("p")), _article_paragraphs(page, every_article)
    use_own = box.isNotNull() & (F.size(own) > 0) if retry_empty else box.isNotNull()
    return F.coalesce(page.paragraphs(F.when(use_own, own).otherwise(fallback)), F.lit(""))


def _ld_json_dates(page: Page, parse, keys: list[str], lists: bool) -> Column:
    """First readable date of the ld+json scripts in document order."""
    scripts = page.all(lambda t: (t["tag"] == "script") & (attr(t, "type") == "application/ld+json"))

    def dates_of(script: Column) -> Column:
        body = page.script_text(script)
        single = lambda node: F.coalesce(*[_filled(F.get_json_object(node, f"$.{k}")) for k in keys])
        if not lists:
            return F.array(parse(single(body)))
        items = F.coalesce(F.from_json(body, "array<string>"), F.array(body))
        return F.transform(items, lambda node: parse(single(node)))

    return F.get(F.filter(F.flatten(F.transform(scripts, dates_of)), lambda d: d.isNotNull()), F.lit(0))


# -- forum pages ------------------------------------------------------------------------------
def forum_list(documents: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Posts of a list page; entries without a link (deleted posts) and announcements drop out."""
    page, entry = Page(), F.col("entry")
    box = lambda name: page.first_inside(entry, tag_with_class("div", name))
    rows = documents.withColumn("doc", outline(F.col(body))).select(
        *keep, "doc", F.explode(page.all(tag_with_class("div", "r-ent"))).alias("entry"))
    rows = computed_once(rows, *keep, "doc", box("title").alias("_title"), box("author").alias("_author"), box("nrec").alias("_nrec"))
    rows = computed_once(
        rows, *keep, text.strip(page.raw_text(F.col("_title"))).alias("title"),
        page.first_inside(F.col("_title"), is_tag("a")).alias("link"),
        text.strip(page.raw_text(F.col("_author"))).alias("author"),
        F.coalesce(_filled(text.strip(page.raw_text(F.col("_nrec")))), F.lit("0")).alias("push_text"))
    url = F.concat(F.lit(FORUM_BASE), attr(F.col("link"), "href"))
    return rows.where(F.col("link").isNotNull() & ~text.has_skip_keyword(F.col("title"))).select(
        *keep, "title", url.alias("url"), "author", text.push_decode(F.col("push_text")).alias("push_count"),
        dates.ts_from_post_url(url).cast("timestamp_ntz").alias("published_at"))


def forum_article(documents: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Own text and comments of a post page; pages without a main block drop out.

    Comments, head lines and system lines are left out of the text: the text pieces they cover are subtracted.
    """
    page, main = Page(), F.col("main")
    push = tag_with_class("div", "push")
    boilerplate = page.inside(main, lambda t: push(t) | ((t["tag"] == "div") & attr(t, "class").contains("article"))
                              | tag_with_class("span", "f2")(t))
    span = lambda lo, hi: F.when(hi > lo, F.sequence(lo, hi - 1)).otherwise(F.array().cast("array<int>"))
    left = F.array_except(span(main["lo"], main["hi"]),
                          F.flatten(F.transform(boilerplate, lambda t: span(t["lo"], t["hi"]))))
    words = F.array_join(F.transform(left, lambda i: F.get(page.texts, i)), "")

    def comment(p: Column) -> Column:
        part = lambda name: text.strip(page.raw_text(page.first_inside(p, tag_with_class("span", name))))
        return F.struct(part("push-userid").alias("author"), part("push-tag").alias("push_tag"),
                        part("push-content").alias("message"))

    comments = F.filter(F.transform(page.inside(main, push), comment), lambda c: (
        c["author"].isNotNull() & c["push_tag"].isNotNull() & c["message"].isNotNull()))
    rows = computed_once(
        documents.withColumn("doc", outline(F.col(body))), *keep, "doc",
        page.first(lambda t: (t["tag"] == "div") & (attr(t, "id") == "main-content")).alias("main"))
    return rows.where("main IS NOT NULL").select(
        *keep, text.clean_body_lines(words).alias("content"), comments.alias("comments"))


# -- API bodies ---------------------------------------------------------------------------------
def news_item(items: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Articles of the news API; items without id, body or time drop out."""
    body = F.coalesce(_filled(F.col("content")), _filled(F.col("summary")))
    usable = (F.coalesce("newsId", F.lit(0)) != 0) & body.isNotNull() & (F.coalesce("publishAt", F.lit(0)) != 0)
    return items.where(usable).select(
        *keep, text.strip(F.coalesce("title", F.lit(""))).alias("title"), html_to_text(body).alias("content"),
        F.concat(F.lit(NEWS_ITEM_URL), F.col("newsId").cast("string")).alias("url"), "author",
        dates.epoch_to_ts(F.col("publishAt")).cast("timestamp_ntz").alias("published_at"))


def forum_post(posts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Articles of the forum API; posts without id or with an unreadable time drop out."""
    body = text.blank_removed(text.strip(F.coalesce("selftext", F.lit(""))))
    at = dates.epoch_to_ts(F.col("created_utc").try_cast("double"))
    return posts.where((F.coalesce("id", F.lit("")) != "") & at.isNotNull()).select(
        *keep, text.strip(F.coalesce("title", F.lit(""))).alias("title"), body.alias("content"),
        F.concat(F.lit(POST_BASE), F.coalesce("permalink", F.lit(""))).alias("url"), "author",
        text.push_clamp(F.col("score")).alias("push_count"), at.cast("timestamp_ntz").alias("published_at"))


# -- news pages ------------------------------------------------------------------------------------
# Each job first takes the texts it needs out of the outline, one column per text, and reads them afterwards: the
# expressions that walk the tag list then stand in the plan once.
def news_page(documents: DataFrame, source: str | Column, body: str = "raw_html", keep: tuple[str, ...] = ()) -> DataFrame:
    """Title, text and time of a stored page, each null when not found."""
    page = Page()
    parse = lambda c: dates.parse_iso(c, date_only=False)
    metas = [page.meta(attribute, name) for attribute in ("property", "name") for name in REPAIR_DATE_METAS]
    found = computed_once(
        documents.withColumn("doc", outline(F.col(body))), *keep, text.strip(page.meta("property", "og:title")).alias("_og"), page.text(page.first(is_tag("h1"))).alias("_h1"),
        _body_text(page, source, every_article=False, retry_empty=True).alias("_body"),
        F.array_compact(F.array(*metas)).alias("_metas"),
        _ld_json_dates(page, parse, ["datePublished", "dateCreated"], lists=False).alias("_ld"))
    return found.select(
        *keep, F.coalesce(_filled(F.col("_og")), _filled(F.col("_h1"))).alias("title"), _filled(F.col("_body")).alias("content"),
        F.coalesce(_first_readable(F.col("_metas"), parse), "_ld").cast("timestamp_ntz").alias("published_at"))


def full_page(documents: DataFrame, source: str = "cnn", body: str = "raw_html", url: str = "url",
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Page fetched for a bare sitemap address; short texts drop out, a missing title is taken from the address."""
    page = Page()
    found = computed_once(
        documents.withColumn("doc", outline(F.col(body))), *keep, F.col(url).alias("_url"), _filled(page.meta("property", "og:title")).alias("_og"),
        page.text(page.first(is_tag("title"))).alias("_title"),
        _body_text(page, source, every_article=True, retry_empty=False).alias("content"),
        page.meta("property", "article:published_time").alias("_at"))
    title = F.when(F.col("_og").isNotNull(), text.strip(F.col("_og"))).otherwise(F.col("_title"))
    return found.where(F.length("content") >= FULL_PAGE_MIN).select(
        *keep, F.coalesce(_filled(title), text.last_path_segment(F.col("_url"))).alias("title"), "content",
        dates.parse_iso(F.col("_at"), plain_clock=False).cast("timestamp_ntz").alias("published_at"))


def archive_page(documents: DataFrame, body: str = "raw_html", stamp: str = "timestamp", url: str = "original",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Article from an archive snapshot; a missing title, text or time drops the page."""
    page = Page()
    parse = lambda c: dates.parse_iso(text.strip(c))
    article = page.first(is_tag("article"))
    box = page.first(lambda t: (t["tag"] == "div") & attr(t, "class").rlike(ARCHIVE_CONTAINER))
    paragraphs = F.when(article.isNotNull(), page.inside(article, is_tag("p"))).when(
        box.isNotNull(), page.inside(box, is_tag("p"))).otherwise(page.all(is_tag("p")))
    clock = page.first(is_tag("time"))
    # For one name the property form wins over the name form, even when its date cannot be read.
    metas = [F.coalesce(_first_meta(page, "property", n), _first_meta(page, "name", n)) for n in ARCHIVE_DATE_METAS]
    found = computed_once(
        documents.withColumn("doc", outline(F.col(body))), *keep, F.col(url).alias("_url"), F.col(stamp).alias("_stamp"),
        text.strip(page.meta("property", "og:title")).alias("_og"), text.strip(page.meta("name", "title")).alias("_meta"),
        page.text(page.first(is_tag("h1"))).alias("_h1"), page.text(page.first(is_tag("title"))).alias("_title"),
        page.paragraphs(paragraphs).alias("content"),
        F.array_compact(F.array(*metas, F.coalesce(_filled(attr(clock, "datetime")), page.text(clock)))).alias("_dates"),
        _ld_json_dates(page, parse, ["datePublished"], lists=True).alias("_ld"))
    title = F.coalesce(_filled(F.col("_og")), _filled(F.col("_meta")), _filled(F.col("_h1")),
                       _filled(text.strip_title_suffix(F.col("_title"))))
    published = F.coalesce(_first_readable(F.col("_dates"), parse), F.col("_ld"), dates.date_from_url(F.col("_url")),
                           dates.snapshot_stamp(F.col("_stamp")))
    return found.where(F.length("content") >= ARCHIVE_MIN).select(
        *keep, title.alias("title"), "content", urls.canonical_url(F.col("_url")).alias("url"),
        published.cast("timestamp_ntz").alias("published_at")).where("title IS NOT NULL AND published_at IS NOT NULL")


def _first_readable(texts: Column, parse) -> Column:
    """First text of the array that is a date."""
    return F.get(F.filter(F.transform(texts, lambda t: parse(t)), lambda d: d.isNotNull()), F.lit(0))


def _first_meta(page: Page, attribute: str, name: str) -> Column:
    """Content of the first such meta tag, empty text when the tag has none, null when there is no such tag."""
    tag = page.first(lambda t: (t["tag"] == "meta") & (attr(t, attribute) == name))
    return F.when(tag.isNotNull(), attr(tag, "content"))


def page_titles(documents: DataFrame, body: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    page = Page()
    return documents.withColumn("doc", outline(F.col(body))).select(
        *keep, page.text(page.first(is_tag("h1"))).alias("h1"), page.text(page.first(is_tag("title"))).alias("title"))


# -- model answers -----------------------------------------------------------------------------------
def label_response(answers: DataFrame, answer: str, articles: str) -> DataFrame:
    """Labels out of a model's answer to a numbered list. ``articles`` is the array of article ids that were asked.

    A code fence around the JSON is cut; unknown moods and indexes outside the list drop out.
    """
    body = text.strip(F.col(answer))
    lines = F.split(body, "\n")
    inner = F.when(body.startswith("```"), F.array_join(
        F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 2, F.lit(0))), "\n")).otherwise(body)
    schema = "array<struct<text_index:string,sentiment:string,confidence:double>>"
    rows = answers.select(F.col(articles).alias("ids"), F.explode(F.from_json(inner, schema)).alias("x")).select(
        "ids", F.when(F.col("x.text_index").rlike(r"^\s*[+-]?[0-9]+(\.[0-9]+)?\s*$"),
                      F.col("x.text_index").try_cast("double").cast("bigint")).alias("text_index"),
        F.lower("x.sentiment").alias("label"), F.coalesce("x.confidence", F.lit(0.0)).alias("confidence"))
    return rows.where(F.col("label").isin("positive", "neutral", "negative") & (F.col("text_index") >= 0)
                      & (F.col("text_index") < F.size("ids"))).select(
        F.get("ids", F.col("text_index").cast("int")).alias("article_id"), "label", "confidence")
