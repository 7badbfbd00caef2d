"""Landed bodies of every source to article rows of one shape.

``landed`` holds source, kind, url and body; kind says what the body is: list, post, listing, bulk, sitemap, index, month, page, cdx. All sources give title, content, url,
author, push_count, published_at and comments. Bodies of a kind that no job of their source reads are counted by :func:`unread`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from moodtide import config
from moodtide.functions import pii, text
from moodtide.operators import merge, quality
from moodtide.operators.numbering import ranked
from moodtide.sources import feeds, parsers

_COMMENTS = "array<struct<author:string,push_tag:string,message:string>>"
_SHAPE = {"title": "string", "content": "string", "url": "string", "author": "string", "push_count": "bigint",
          "published_at": "timestamp_ntz", "comments": _COMMENTS}
SITEMAP_BODY_CHARS = 51  # fixed value: a page text has to be longer than 50 characters


def _shaped(df: DataFrame, source: str) -> DataFrame:
    columns = [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in _SHAPE.items()]
    return df.select(F.lit(source).alias("source_name"), *columns)


def _kind(landed: DataFrame, source: str, kind: str) -> DataFrame:
    return landed.where((F.col("source") == source) & (F.col("kind") == kind))


def forum_tw(landed: DataFrame) -> DataFrame:
    """List entries with the page of their post; without one they wait for the next run."""
    entries = parsers.forum_list(_kind(landed, "ptt", "list"))
    posts = parsers.forum_article(_kind(landed, "ptt", "post"), keep=("url",))
    return _shaped(entries.join(posts, "url"), "ptt")


def news_tw(landed: DataFrame) -> DataFrame:
    return _shaped(parsers.news_item(feeds.news_items(_kind(landed, "cnyes", "listing"))), "cnyes")


def forum_us(landed: DataFrame) -> DataFrame:
    posts = feeds.forum_posts(_kind(landed, "reddit", "listing")).unionByName(feeds.bulk_posts(_kind(landed, "reddit", "bulk")))
    return _shaped(parsers.forum_post(posts), "reddit")


def sitemap_news(landed: DataFrame, source: str) -> DataFrame:
    """News sitemap entries, of sitemaps that were landed or that a landed index leads to, with the text of their page; the title stands in for a missing or short text."""
    maps = _kind(landed, source, "sitemap")
    below = feeds.expand_index(_kind(landed, source, "index"), landed.where((F.col("source") == source) & F.col("kind").isin("sitemap", "index")))
    entries = feeds.sitemap_entries(maps).drop("position").unionByName(below.drop("root", "sitemap", "position"))
    first = entries.groupBy("url").agg(F.min(F.struct("published_at", "title")).alias("e")).select("url", "e.title", "e.published_at")
    pages = parsers.news_page(_kind(landed, source, "page"), source, body="body", keep=("url",)).select(
        "url", text.at_least(F.col("content"), SITEMAP_BODY_CHARS).alias("content"))
    return _shaped(first.join(pages, "url", "left").withColumn("content", F.coalesce("content", "title")), source)


def archive(landed: DataFrame, source: str) -> DataFrame:
    """Articles of an archive: the earliest snapshot of each address in the landed index answers, with its page; without one it waits for a later run."""
    rows = feeds.archive_index_rows(_kind(landed, source, "cdx"), F.lit(config.ARCHIVE_SOURCES[source]["article_pattern"]), keep=("url",))
    snapshots = feeds.earliest_snapshots(rows.withColumnRenamed("url", "answer"), landed.where("false"), ["answer", "position"])
    return archived(snapshots, _kind(landed, source, "page"), source)


def archived(snapshots: DataFrame, pages: DataFrame, source: str) -> DataFrame:
    """Articles of the snapshots (timestamp, original) whose page is landed."""
    wanted = snapshots.withColumn("url", feeds.snapshot_address(F.col("timestamp"), F.col("original")))
    bodies = pages.select("url", "body").groupBy("url").agg(F.max("body").alias("body"))
    return _shaped(parsers.archive_page(wanted.join(bodies, "url").drop("url"), body="body"), source)


def sitemap_cnn(landed: DataFrame) -> DataFrame:
    """News feed and month feed of one site; addresses only the month feed knows take title and text from their page."""
    feed = feeds.merge_feeds(feeds.sitemap_entries(_kind(landed, "cnn", "sitemap")),
                             feeds.month_entries(_kind(landed, "cnn", "month"))).where(text.in_section(F.col("url")))
    pages = parsers.full_page(_kind(landed, "cnn", "page"), "cnn", body="body", keep=("url",)).select(
        "url", *[F.col(c).alias(f"page_{c}") for c in ("title", "content", "published_at")])
    both = feed.join(pages, "url", "left").where(~F.col("needs_full_fetch") | F.col("page_content").isNotNull())
    own = F.col("needs_full_fetch")
    body = text.at_least(F.col("page_content"), SITEMAP_BODY_CHARS)
    return _shaped(both.select(
        "url", F.when(own, F.col("page_title")).otherwise(F.col("title")).alias("title"),
        F.when(own, F.col("page_content")).otherwise(F.coalesce(body, "title")).alias("content"),
        F.when(own, F.coalesce("published_at", "page_published_at")).otherwise(F.col("published_at")).alias("published_at")), "cnn")


JOBS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "ptt": forum_tw, "cnyes": news_tw, "reddit": forum_us, "cnn": sitemap_cnn,
    "wsj": lambda landed: sitemap_news(landed, "wsj"),
    # This site's pages are closed: its entries never have a page, so the title is the text.
    "marketwatch": lambda landed: sitemap_news(landed, "marketwatch"),
    "wayback_cnn": lambda landed: archive(landed, "wayback_cnn"),
    "wayback_wsj": lambda landed: archive(landed, "wayback_wsj"),
}
#: Kinds of bodies the job of a source reads.
KINDS = {
    "ptt": ("list", "post"), "cnyes": ("listing",), "reddit": ("listing", "bulk"), "cnn": ("sitemap", "month", "page"), "wsj": ("sitemap", "index", "page"),
    "marketwatch": ("sitemap", "index", "page"), "wayback_cnn": ("cdx", "page"), "wayback_wsj": ("cdx", "page"),
}


def unread(landed: DataFrame) -> DataFrame:
    """``source, kind, bodies`` of what no job reads."""
    read = F.lit(False)
    for source, kinds in KINDS.items():
        read = read | (F.col("source").eqNullSafe(source) & F.coalesce(F.col("kind").isin(*kinds), F.lit(False)))
    return landed.where(~read).groupBy("source", "kind").agg(F.count(F.lit(1)).alias("bodies"))


def routed(landed: DataFrame, as_of) -> DataFrame:
    """Articles of all sources with ``valid`` and ``reasons``."""
    return quality.validate_articles(quality.union_all([job(landed) for job in JOBS.values()]), as_of)


def scraped(landed: DataFrame, as_of) -> DataFrame:
    """Valid articles of all sources."""
    return routed(landed, as_of).where("valid").drop("valid", "reasons")


def quarantine(rows: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Write validated rows once, those that hold beside those that do not: the valid ones, and the counts by outcome and reason as they were seen on the way.

    A row with several reasons counts for each. What was rejected stays readable, with its reasons, by :func:`rejected`.
    """
    seen = Observation()
    counts = [F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("rejected"),
              *[F.count_if(F.array_contains("reasons", r)).alias(r) for r in quality.REASONS]]
    rows.observe(seen, *counts).write.mode("overwrite").partitionBy("valid").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).where("valid").drop("valid", "reasons"), seen.get


def rejected(spark, path: str, schema) -> DataFrame:
    """Rejected rows below a folder of :func:`quarantine`; the valid ones are another partition and are not read."""
    return spark.read.schema(schema).parquet(path).where("NOT valid").drop("valid")


def masked(rows: DataFrame) -> DataFrame:
    """Authors of articles and of their nested comments as pseudonyms."""
    comments = F.transform("comments", lambda c: F.struct(
        pii.mask_author(c["author"]).alias("author"), c["push_tag"].alias("push_tag"), c["message"].alias("message")))
    return rows.withColumns({"author": pii.mask_author(F.col("author")), "comments": comments})


def new_articles(found: DataFrame, stored: DataFrame, sources: DataFrame, first_id: int, scraped_at) -> DataFrame:
    """Articles whose address is not stored yet, numbered on from ``first_id``; nested comments still attached."""
    fresh = merge.new_rows(stored, found.withColumn("_order", F.sha2(F.to_json(F.struct("title", "source_name", "published_at")), 256)),
                           ["url"], ["published_at", "_order"]).drop("_order")
    numbered = ranked(fresh, [], F.sha2(F.col("url"), 256), "_rank")
    return numbered.join(sources.select("source_id", "source_name"), "source_name").select(
        (F.col("_rank") + (first_id - 1)).alias("article_id"), "source_id", "title", "push_count", "author", "url", "content",
        "published_at", scraped_at.alias("scraped_at"), "comments")


def new_comments(articles: DataFrame) -> DataFrame:
    return articles.select("article_id", F.posexplode("comments").alias("place", "c")).select(
        "article_id", "place", "c.author", "c.push_tag", "c.message")
