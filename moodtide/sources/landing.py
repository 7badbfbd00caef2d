"""The landing zone: append-only raw rows and the latest body per URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}
ARTICLE_FIELDS = ["url", "title", "author", "content", "push_count", "published_at", "scraped_at"]


def _stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def raw_articles(articles: DataFrame, source_name: Column, ingested_at: Column) -> DataFrame:
    """One JSON row per parsed article, dates as text, nothing removed. Nested comments travel along."""
    fields = ["title", "content", "url", "author", "published_at", "push_count"]
    fields += [c for c in ("comments",) if c in articles.columns]
    values = [_stamp(F.col(f)).alias(f) if f == "published_at" else F.col(f) for f in fields]
    return articles.select(source_name.alias("source_name"), F.to_json(F.struct(*values), _KEEP_NULLS).alias("raw_payload"),
                           ingested_at.alias("ingested_at"))


def raw_scores(scores: DataFrame, ingested_at: str) -> DataFrame:
    """Raw score rows keyed by the article key the scorer was given, else by its URL. ``ingested_at`` names a column
    that is not part of the payload."""
    fields = [f for f in scores.columns if f != ingested_at]
    key = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("article_id_raw", "url") if c in fields])
    return scores.select(key.alias("article_id_raw"), F.to_json(F.struct(*fields), _KEEP_NULLS).alias("raw_payload"),
                         F.col(ingested_at).alias("ingested_at"))


def append(df: DataFrame, path: str) -> None:
    """Append raw rows, one folder per ingest day."""
    (df.withColumn("ingest_day", F.to_date("ingested_at")).write.mode("append").partitionBy("ingest_day").parquet(path))


def response_document(responses: DataFrame) -> DataFrame:
    """Body as HTML or JSON by content type. ``responses``: source, url, fetched_at, http_status, content_type, body."""
    is_json = F.coalesce(F.col("content_type"), F.lit("")).contains("json")
    return responses.select("source", "url", "fetched_at", "http_status",
                            F.when(~is_json, F.col("body")).alias("raw_html"),
                            F.when(is_json, F.col("body")).alias("raw_json"))


def latest_responses(documents: DataFrame) -> DataFrame:
    """Latest document per URL.

    A later fetch sets only the fields it carries: a body of the other kind from an earlier fetch stays.
    """
    at = F.col("fetched_at")
    last_known = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c)
    return documents.groupBy("url").agg(
        F.max_by("source", at).alias("source"), F.max(at).alias("fetched_at"),
        F.max_by("http_status", at).alias("http_status"), last_known("raw_html"), last_known("raw_json"))


def backfill(articles: DataFrame, sources: DataFrame, raw: DataFrame, masked: bool = False) -> DataFrame:
    """Raw rows for stored articles that no raw row refers to yet. Running it twice adds nothing.

    Authors that were masked before are marked, so that staging does not have to guess.
    """
    done = raw.select(F.get_json_object("raw_payload", "$.oltp_article_id").cast("bigint").alias("article_id"))
    missing = articles.join(done.where("article_id IS NOT NULL"), "article_id", "left_anti").join(
        sources.select("source_id", "source_name"), "source_id")
    payload = F.to_json(F.struct(
        "url", "title", "author", "content", "push_count", _stamp(F.col("published_at")).alias("published_at"),
        _stamp(F.col("scraped_at")).alias("scraped_at"), F.col("article_id").alias("oltp_article_id"),
        F.lit(masked).alias("masked")), _KEEP_NULLS)
    return missing.select("source_name", payload.alias("raw_payload"), F.col("scraped_at").alias("ingested_at"))
