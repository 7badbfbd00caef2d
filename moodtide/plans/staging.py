"""Raw layer to staging to joined articles (the EL+T branch)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtide import config
from moodtide.functions import dates, pii, text
from moodtide.functions.once import computed_once
from moodtide.operators.dedup import latest

_ARTICLE_FIELDS = ["url", "title", "author", "content", "push_count", "published_at", "scraped_at"]
_SCORE_FIELDS = ["score", "calculated_at"]


def _fields(names: list[str]) -> T.StructType:
    """Every JSON field as its text, so that no value is read with a wrong type."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


#: Staged columns and the payload field each is read from.
_FIELD_OF = {"title": "title", "author_hash": "author", "content": "content", "push_count": "push_count", "published_at": "published_at",
             "scraped_at": "scraped_at"}
_STAGED = ["article_id", "url", "source_name", "title", "author_hash", "content", "push_count", "published_at", "scraped_at", "ingest_time", "source_system"]


def extract_articles(raw: DataFrame, fields: list[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Typed fields of each raw delivery; the payload is parsed once. ``fields`` limits them to some payload fields besides the URL; ``keep`` adds columns of ``raw``."""
    wanted = [f for f in _ARTICLE_FIELDS if f == "url" or fields is None or f in fields]
    p = computed_once(raw, "raw_id", "source_name", "ingested_at", *keep,
                      F.from_json("raw_payload", _fields(wanted)).alias("p"))
    field, source = (lambda f: F.col(f"p.{f}")), F.col("source_name")
    typed = {
        "title": lambda: text.blank_to_null(field("title")).alias("title"),
        "author": lambda: text.blank_to_null(field("author")).alias("author_raw"),
        "content": lambda: F.nullif(field("content"), F.lit("")).alias("content"),
        "push_count": lambda: text.guarded_int(field("push_count")).alias("push_count"),
        "published_at": lambda: _ntz(dates.parse_date_by_source(field("published_at"), source)).alias("published_at"),
        "scraped_at": lambda: _ntz(dates.parse_date_by_source(field("scraped_at"), source)).alias("scraped_raw"),
    }
    return p.select(text.blank_to_null(field("url")).alias("url"), "raw_id", "source_name", "ingested_at", *keep, *[typed[f]() for f in wanted if f != "url"])


def stage_articles(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Latest delivery per URL; the id is the smallest raw id the URL ever had, so it never changes.

    The payload is parsed once, for the wanted ``columns`` only. Of deliveries that share time and id the one of the largest payload hash wins, so a row that was
    landed twice is one row; a null id or time is older than any other.
    """
    columns = columns or _STAGED
    rows = extract_articles(raw.withColumn("_mark", F.xxhash64("raw_payload")), [_FIELD_OF[c] for c in columns if c in _FIELD_OF], keep=["_mark"])
    last = latest(rows.where("url IS NOT NULL"), ["url"], ["ingested_at", "raw_id", "_mark"], [F.min("raw_id").alias("article_id")])
    made = {"author_hash": lambda: pii.pii_hash(F.col("author_raw")), "scraped_at": lambda: F.coalesce("scraped_raw", "ingested_at"),
            "ingest_time": lambda: F.col("ingested_at"), "source_system": lambda: F.lit("raw_articles")}
    return last.select(*[made.get(c, lambda: F.col(c))().alias(c) for c in columns])


def stage_scores(raw: DataFrame) -> DataFrame:
    p = raw.where("article_id_raw IS NOT NULL").select(
        "article_id_raw", "raw_id", "ingested_at", F.from_json("raw_payload", _fields(_SCORE_FIELDS)).alias("p"))
    rows = p.select(
        "article_id_raw", "raw_id", "ingested_at",
        text.guarded_float(F.col("p.score")).alias("score"),
        dates.guarded_timestamp(F.col("p.calculated_at")).alias("calculated_at"))
    return latest(rows, ["article_id_raw"], ["ingested_at", "raw_id"]).select(
        F.sha2(F.col("article_id_raw").cast("binary"), 256).alias("score_id"),
        "article_id_raw", "score", "calculated_at", F.col("ingested_at").alias("ingest_time"),
        F.lit("raw_sentiment_scores").alias("source_system"))


def stage_sources(raw: DataFrame) -> DataFrame:
    rows = raw.select(
        F.nullif(F.trim(F.lower("source_name")), F.lit("")).alias("source_name"), "raw_id", "ingested_at",
        text.blank_to_null(F.from_json("raw_payload", _fields(["url"]))["url"]).alias("source_url"),
    ).where("source_name IS NOT NULL")
    return latest(rows, ["source_name"], ["ingested_at", "raw_id"], [F.min("raw_id").alias("source_id")]).select(
        "source_id", "source_name", "source_url", F.col("ingested_at").alias("ingest_time"),
        F.lit("raw_sources").alias("source_system"))


def articles_with_sentiment(articles: DataFrame, scores: DataFrame) -> DataFrame:
    """Staged articles with their score by URL; of the articles those columns that were staged."""
    s = scores.select(F.col("article_id_raw").alias("url"), F.col("score").alias("sentiment_score"),
                      F.col("calculated_at").alias("sentiment_score_calculated_at"))
    return articles.join(s, "url", "left").select(
        *[c for c in _STAGED if c in articles.columns and c != "source_system"], "sentiment_score", "sentiment_score_calculated_at")


def market_articles(with_sentiment: DataFrame, sources: DataFrame) -> DataFrame:
    return with_sentiment.join(sources.select("source_name", "source_id", "source_url"), "source_name", "left").select(
        "article_id", "url", "source_name", "source_id", "source_url",
        config.market_for_source(F.col("source_name")).alias("market_code"),
        "title", "author_hash", "push_count", "published_at", "scraped_at",
        "sentiment_score", "sentiment_score_calculated_at", "ingest_time")


# -- typed views over the relational layer ------------------------------------------
def typed_articles(articles: DataFrame) -> DataFrame:
    return articles.select(
        F.col("article_id").cast("bigint").alias("article_id"), F.col("source_id").cast("int").alias("source_id"),
        F.col("url").cast("string").alias("url"), F.col("title").cast("string").alias("title"),
        F.col("author").cast("string").alias("author_hash"), F.col("content").cast("string").alias("content"),
        F.col("push_count").cast("int").alias("push_count"),
        F.col("published_at").cast("timestamp_ntz").alias("published_at"),
        F.col("scraped_at").cast("timestamp_ntz").alias("scraped_at"))


def typed_scores(scores: DataFrame) -> DataFrame:
    return scores.select(F.col("article_id").cast("bigint").alias("article_id"),
                         F.col("score").cast("double").alias("score"),
                         F.col("calculated_at").cast("timestamp_ntz").alias("calculated_at"))


def typed_sources(sources: DataFrame) -> DataFrame:
    return sources.select(F.col("source_id").cast("int").alias("source_id"),
                          F.col("source_name").cast("string").alias("source_name"),
                          F.col("url").cast("string").alias("source_url"))


def comments_from_raw(raw: DataFrame) -> DataFrame:
    """Nested comments of the raw payload, one row each."""
    schema = "url string, comments array<struct<author:string,push_tag:string,message:string>>"
    return (raw.select(F.from_json("raw_payload", schema).alias("p"))
            .select("p.url", F.inline("p.comments")))
