"""Repair of stored articles from the landed bodies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.functions import dates, text
from moodtide.functions.html import html_to_text
from moodtide.operators import merge, quality
from moodtide.session import shared_dir
from moodtide.sources import feeds, parsers
from moodtide.sources.bodies import BodyStore
from moodtide.sources.keyed import KeyedTable
from moodtide.sources.parsers import BODY_CONTAINERS

FIELDS = ["title", "content", "published_at"]
NEWS_SITES = list(BODY_CONTAINERS)


def _forum_fixes(bad: DataFrame) -> DataFrame:
    parsed = parsers.forum_article(bad.where("source_name = 'ptt' AND raw_html IS NOT NULL"), body="raw_html",
                                   keep=("article_id", "url"))
    return parsed.select("article_id", F.lit(None).cast("string").alias("title"),
                         F.nullif("content", F.lit("")).alias("content"),
                         dates.ts_from_post_url(F.col("url")).cast("timestamp_ntz").alias("published_at"))


def _news_item_fixes(bad: DataFrame) -> DataFrame:
    """The item of the stored listing whose id is in the address."""
    wanted = F.regexp_extract("url", r"/news/id/([0-9]+)", 1).try_cast("bigint")
    items = feeds.news_items(bad.where("source_name = 'cnyes' AND raw_json IS NOT NULL"), body="raw_json",
                             keep=("article_id", "url")).where(F.col("newsId") == wanted)
    body = F.coalesce(F.nullif("content", F.lit("")), F.nullif("summary", F.lit("")))
    return items.select(
        "article_id", F.nullif(text.strip("title"), F.lit("")).alias("title"),
        F.nullif(html_to_text(body), F.lit("")).alias("content"),
        F.timestamp_seconds(F.nullif("publishAt", F.lit(0))).cast("timestamp_ntz").alias("published_at"))


def _forum_post_fixes(bad: DataFrame) -> DataFrame:
    wanted = F.regexp_extract("url", r"/comments/(\w+)/", 1)
    posts = feeds.forum_posts(bad.where("source_name = 'reddit' AND raw_json IS NOT NULL"), body="raw_json",
                              keep=("article_id", "url")).where(F.col("id") == wanted)
    body = text.blank_removed(text.strip(F.col("selftext")))
    at = F.timestamp_micros(F.rint(F.nullif(F.col("created_utc").try_cast("double"), F.lit(0.0)) * 1e6).try_cast("bigint"))
    return posts.select("article_id", F.nullif(text.strip("title"), F.lit("")).alias("title"),
                        F.nullif(body, F.lit("")).alias("content"), at.cast("timestamp_ntz").alias("published_at"))


def _page_fixes(bad: DataFrame) -> DataFrame:
    """Pages of all news sites in one job, each read with the rules of its own site."""
    return parsers.news_page(bad.where(F.col("source_name").isin(NEWS_SITES) & F.col("raw_html").isNotNull()),
                             F.col("source_name"), keep=("article_id",))


def fixes(articles: DataFrame, sources: DataFrame, responses: DataFrame) -> DataFrame:
    """Fields that can be read again, one row per repairable article.

    Only bad rows meet the bodies; all of them do, there is no batch limit. ``responses``: url, raw_html, raw_json.
    """
    bad = quality.diagnose(articles, sources).join(responses.select("url", "raw_html", "raw_json"), "url")
    jobs = [_forum_fixes, _news_item_fixes, _forum_post_fixes, _page_fixes]
    found = quality.union_all([job(bad).select("article_id", *FIELDS) for job in jobs])
    # A listing may hold an id twice: the first value of each field counts.
    one = found.groupBy("article_id").agg(*[F.min(f).alias(f) for f in FIELDS])
    return one.where(" OR ".join(f"{f} IS NOT NULL" for f in FIELDS))


def repair(articles: DataFrame, sources: DataFrame, responses: DataFrame) -> DataFrame:
    """Articles with every re-read field filled in; fields that could not be read keep their value."""
    return merge.patch(articles, fixes(articles, sources, responses), ["article_id"], FIELDS)


def check_and_repair(articles: DataFrame, sources: DataFrame, responses: DataFrame,
                     check: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Check; when that fails repair and check again; raise when it still fails or nothing could be repaired."""
    try:
        quality.enforce(check(articles))
        return articles
    except quality.QualityError:
        found = settled_fixes(articles, sources, responses)
        if found.isEmpty():
            raise
        mended = merge.patch(articles, found, ["article_id"], FIELDS)
        quality.enforce(check(mended))
        return mended


def settled_fixes(articles: DataFrame, sources: DataFrame, responses: DataFrame) -> DataFrame:
    """:func:`fixes`, written down: bodies are read and parsed once, whatever is done with the result."""
    folder = shared_dir(articles.sparkSession, "fixes")
    fixes(articles, sources, responses).write.parquet(folder)
    return articles.sparkSession.read.parquet(folder)


def check_and_mend(table: KeyedTable, sources: DataFrame, bodies: BodyStore, check: Callable[[DataFrame], DataFrame]) -> int:
    """The same over a stored table by URL: only bad rows' bodies are read, and only units that hold a mended row are written. The number of mended rows."""
    articles = table.read()
    try:
        quality.enforce(check(articles))
        return 0
    except quality.QualityError:
        bad = quality.diagnose(articles, sources)
        found = settled_fixes(articles, sources, bodies.documents(bad))
        if found.isEmpty():
            raise
        table.patch(found.join(articles.select("article_id", "url"), "article_id").drop("article_id"), FIELDS)
        quality.enforce(check(table.read()))
        return found.count()
