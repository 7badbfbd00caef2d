"""Dimensions, daily facts and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide import config
from moodtide.functions.numbers import numeric, weighted_avg


# -- dimensions -----------------------------------------------------------------------
def dim_market(spark) -> DataFrame:
    return config.market_frame(spark)


def dim_stock(spark) -> DataFrame:
    return config.stock_frame(spark)


def dim_source(sources: DataFrame) -> DataFrame:
    """Sources with market and tracked instrument; an unknown source counts to the default market without one."""
    name = F.col("source_name")
    market = F.coalesce(config.market_for_source(name), F.lit(config.DEFAULT_MARKET))
    ids = {code: str(i) for i, code, *_ in config.MARKETS}
    return sources.select("source_id", "source_name", "url", config.lookup(market, ids).cast("int").alias("market_id"),
                          config.stock_for_source(name).alias("tracked_stock"))


# -- facts ------------------------------------------------------------------------------
def fact_sentiment(articles: DataFrame, scores: DataFrame, sources: DataFrame, dims: DataFrame) -> DataFrame:
    """Posts per publication day and source; posts without a score count as articles but not as scored ones.

    The names are joined after the aggregation: it only needs the source id, and what is left is one row per day and
    source.
    """
    a = articles.select("article_id", "source_id", F.to_date("published_at").alias("fact_date"), "push_count")
    s = scores.select("article_id", "score")
    daily = a.join(s, "article_id", "left").groupBy("fact_date", "source_id").agg(
        F.count("article_id").alias("article_count"),
        F.count("score").alias("scored_articles"),
        numeric(F.avg("score"), 6, 4).alias("avg_sentiment"),
        numeric(F.avg("push_count"), 8, 2).alias("avg_push_count"))
    named = daily.join(sources.select("source_id", "source_name"), "source_id")
    return named.join(dims.select("source_id", F.col("tracked_stock").alias("stock_symbol")), "source_id", "left").select(
        "fact_date", "source_id", "stock_symbol", "source_name", "article_count", "scored_articles",
        "avg_sentiment", "avg_push_count")


def _mood_counts(score: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("article_count"),
        F.count_if(score > config.POSITIVE_ABOVE).alias("pos_count"),
        F.count_if(score < config.NEGATIVE_BELOW).alias("neg_count"),
        F.count_if(score.between(config.NEGATIVE_BELOW, config.POSITIVE_ABOVE)).alias("neu_count"),
        F.avg(score).alias("avg_score"),
    ]


def fact_mood(articles: DataFrame, scores: DataFrame, sources: DataFrame) -> DataFrame:
    """Positive, negative and neutral posts per scraping day and source; only scored posts count."""
    a = articles.select("article_id", "source_id", F.to_date("scraped_at").alias("fact_date"))
    daily = a.join(scores.select("article_id", "score"), "article_id").groupBy("fact_date", "source_id").agg(
        *_mood_counts(F.col("score")))
    return daily.join(sources.select("source_id", "source_name"), "source_id").select(
        "fact_date", "source_id", "source_name", "article_count", "pos_count", "neg_count", "neu_count", "avg_score")


def fact_mood_v2(with_sentiment: DataFrame, sources: DataFrame) -> DataFrame:
    """The same measures from the staged articles; a source missing in the master keeps its rows without an id."""
    daily = (with_sentiment.where("sentiment_score IS NOT NULL")
             .groupBy(F.to_date("scraped_at").alias("fact_date"), "source_name")
             .agg(*_mood_counts(F.col("sentiment_score"))))
    return daily.join(sources.select("source_name", "source_id"), "source_name", "left").select(
        "fact_date", "source_id", "source_name", "article_count", "pos_count", "neg_count", "neu_count", "avg_score",
        F.lit("v2").alias("pipeline_version"))


def mood_ratios(fact: DataFrame) -> DataFrame:
    """Shares of positive and negative posts, newest and busiest first."""
    share = lambda c: F.try_divide(F.col(c).cast("double"), F.nullif(F.col("article_count"), F.lit(0)).cast("double"))
    return (fact.withColumn("pos_ratio", share("pos_count")).withColumn("neg_ratio", share("neg_count"))
            .orderBy(F.desc("fact_date"), F.desc("article_count")))


def public_ratios(fact_v1: DataFrame, fact_v2: DataFrame, use_v2: bool) -> DataFrame:
    """The public daily mart; the flag moves it to the second branch, which has no source id."""
    if not use_v2:
        return mood_ratios(fact_v1)
    return mood_ratios(fact_v2).drop("source_id", "pipeline_version")


# -- marts --------------------------------------------------------------------------------
def mart_daily_summary(fact: DataFrame) -> DataFrame:
    """Day and source; the averages weigh the *stored* (rounded) fact measures again."""
    return fact.groupBy(F.col("fact_date").alias("summary_date"), "source_name").agg(
        F.sum("article_count").alias("total_articles"),
        F.sum("scored_articles").alias("scored_articles"),
        numeric(weighted_avg(F.col("avg_sentiment"), F.col("scored_articles")), 6, 4).alias("avg_sentiment"),
        numeric(weighted_avg(F.col("avg_push_count"), F.col("article_count")), 8, 2).alias("avg_push_count"))


def mart_market_summary(fact: DataFrame, dims: DataFrame, markets: DataFrame) -> DataFrame:
    rows = (fact.join(dims.select("source_id", "market_id"), "source_id")
            .join(markets.select("market_id", "market_code"), "market_id"))
    return rows.groupBy("fact_date", "market_code").agg(
        F.countDistinct("source_id").alias("source_count"),
        F.sum("article_count").alias("total_articles"),
        F.sum("scored_articles").alias("scored_articles"),
        numeric(weighted_avg(F.col("avg_sentiment"), F.col("scored_articles")), 5, 4).alias("avg_sentiment"),
        numeric(weighted_avg(F.col("avg_push_count"), F.col("article_count")), 8, 2).alias("avg_push_count"))


def parity(v1: DataFrame, v2: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Both branches side by side: keys only one of them has, and measures that differ."""
    left = v1.select(*keys, *[F.col(m).alias(f"{m}_v1") for m in measures], F.lit(1).alias("_in_v1"))
    right = v2.select(*keys, *[F.col(m).alias(f"{m}_v2") for m in measures], F.lit(1).alias("_in_v2"))
    both = left.join(right, keys, "full")
    state = (F.when(F.col("_in_v2").isNull(), "only_v1").when(F.col("_in_v1").isNull(), "only_v2"))
    for m in measures:
        state = state.when(~F.col(f"{m}_v1").eqNullSafe(F.col(f"{m}_v2")), f"differs_{m}")
    return both.groupBy(state.otherwise("equal").alias("state")).agg(F.count(F.lit(1)).alias("n"))
