"""Read queries of the service and the dashboard. "Today" is always an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide import config
from moodtide.functions.numbers import settled, weighted_avg
from moodtide.functions.text import title_matches

PERIOD_DAYS = {"day": 1, "week": 7, "month": 30, "year": 365}  # fixed values
LIMITS = {"period": (1, 30), "limit": (1, 100), "article_period": (1, 365)}  # fixed values


def _bounded(name: str, value: int) -> int:
    low, high = LIMITS[name]
    if not low <= value <= high:
        raise ValueError(f"{name} has to be between {low} and {high}, got {value}")
    return value


def scored_articles(articles: DataFrame, scores: DataFrame) -> DataFrame:
    """Articles that have a score, in the columns the service returns."""
    a = articles.select("article_id", "title", "push_count", "author", "url", "published_at")
    return a.join(scores.select("article_id", "score"), "article_id").select(
        F.col("article_id").alias("Article_id"), F.col("title").alias("Title"),
        F.col("push_count").alias("Push_count"), F.col("author").alias("Author"), F.col("url").alias("Url"),
        F.col("published_at").alias("Published_Time"), F.col("score").alias("Article_Sentiment_Score"))


def dashboard_articles(articles: DataFrame, scores: DataFrame, sources: DataFrame) -> DataFrame:
    a = articles.select("article_id", "source_id", "title", "push_count", "published_at", "url")
    return (a.join(scores.select("article_id", "score"), "article_id")
            .join(sources.select("source_id", "source_name"), "source_id")
            .select(F.col("article_id").alias("Article_id"), F.col("title").alias("Title"),
                    F.col("push_count").alias("Push_count"), F.to_date("published_at").alias("Date"),
                    F.col("url").alias("Url"), F.col("score").alias("Article_Sentiment_Score"),
                    F.col("source_name").alias("Source")))


# -- daily sentiment -------------------------------------------------------------------------
def daily_sentiment(mart: DataFrame, target: Column, days: int) -> DataFrame:
    """Mart rows of the ``days`` days up to ``target``, newest first."""
    day = F.col("summary_date")
    return (mart.where((day <= target) & (day > F.date_sub(target, days)) & F.col("avg_sentiment").isNotNull())
            .groupBy("summary_date", "source_name")
            .agg(F.sum("total_articles").alias("total_articles"), F.sum("scored_articles").alias("scored_articles"),
                 weighted_avg(F.col("avg_sentiment"), F.col("scored_articles")).alias("avg_sentiment"))
            .orderBy(F.desc("summary_date"), "source_name"))


def daily_sentiment_sql(mart_view: str, name: str = "daily_sentiment") -> str:
    """The same query as a SQL table function over a mart view."""
    return f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(target_date DATE, days INT)
        RETURNS TABLE (summary_date DATE, source_name STRING, total_articles BIGINT, scored_articles BIGINT,
                       avg_sentiment DOUBLE)
        RETURN SELECT m.summary_date, m.source_name, sum(m.total_articles), sum(m.scored_articles),
                      try_divide(CAST(sum(m.avg_sentiment * m.scored_articles) AS DOUBLE),
                                 CAST(nullif(sum(m.scored_articles), 0) AS DOUBLE))
               FROM {mart_view} m
               WHERE m.summary_date <= {name}.target_date
                 AND m.summary_date > date_sub({name}.target_date, {name}.days)
                 AND m.avg_sentiment IS NOT NULL
               GROUP BY m.summary_date, m.source_name"""


def _by_date(rows: DataFrame) -> DataFrame:
    """One weighted score per date over all sources."""
    weight = F.coalesce("scored_articles", "total_articles")
    return rows.groupBy("summary_date").agg(
        F.try_divide(F.sum(F.col("avg_sentiment") * weight), F.sum(weight).cast("double")).alias("score"))


def sentiment_today(mart: DataFrame, today: Column) -> DataFrame:
    by_date = _by_date(daily_sentiment(mart, today, 7))
    last = by_date.agg(F.max("summary_date").alias("date"), F.max_by("score", "summary_date").alias("score"))
    return last.where("date IS NOT NULL").select("date", settled(F.col("score"), 2).alias("sentiment_score"))


def sentiment_change(mart: DataFrame, today: Column) -> DataFrame:
    """Latest date against the available date before it; empty with fewer than two dates."""
    top = _by_date(daily_sentiment(mart, today, 7)).orderBy(F.desc("summary_date")).limit(2)
    pair = top.agg(F.count(F.lit(1)).alias("n"), F.max_by("score", "summary_date").alias("now"),
                   F.min_by("score", "summary_date").alias("before"))
    return pair.where("n = 2").select(settled(F.col("now") - F.col("before"), 2).alias("change_sentiment_score"))


def sentiment_recent(mart: DataFrame, today: Column, period: int = 10) -> DataFrame:
    weight = F.coalesce("scored_articles", "total_articles")
    rows = daily_sentiment(mart, today, _bounded("period", period))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("avg_sentiment") * weight).alias("s"),
                     F.sum(weight).alias("w"))
    score = F.coalesce(F.try_divide(F.col("s"), F.nullif(F.col("w"), F.lit(0)).cast("double")), F.lit(0.0))
    return total.where("n > 0").select(F.lit(period).alias("period"), settled(score, 2).alias("sentiment_score"))


# -- articles --------------------------------------------------------------------------------
def top_push(scored: DataFrame, limit: int = 10, period: int = 7, period_type: str = "day") -> DataFrame:
    """Most pushed articles of the last period before the newest one; ties by id."""
    top, days = _bounded("limit", limit), _bounded("article_period", period) * PERIOD_DAYS[period_type]
    newest = scored.agg(F.max(F.to_date("Published_Time"))).scalar()
    recent = scored.where(F.to_date("Published_Time") >= F.date_sub(newest, days))
    return (recent.orderBy(F.desc_nulls_last("Push_count"), "Article_id").limit(top)
            .select("Title", "Push_count", "Published_Time", "Url"))


def search(scored: DataFrame, keyword: str) -> DataFrame:
    return scored.where(title_matches(F.col("Title"), keyword)).select(
        "Title", F.coalesce("Push_count", F.lit(0)).alias("Push_count"), "Published_Time", "Url")


def most_engaged(board: DataFrame, limit: int = 20) -> DataFrame:
    return (board.orderBy(F.desc_nulls_last("Push_count"), "Article_id").limit(limit)
            .select("Title", "Source", "Push_count", "Article_Sentiment_Score", "Date"))


# -- dashboard -------------------------------------------------------------------------------
def dashboard_filter(board: DataFrame, start: str, end: str, sources: list[str]) -> DataFrame:
    return board.where(F.col("Date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
                       & F.col("Source").isin(sources))


def trend_daily(board: DataFrame) -> DataFrame:
    return board.groupBy("Date").agg(F.avg("Article_Sentiment_Score").alias("avg_sentiment"))


def count_daily(board: DataFrame) -> DataFrame:
    return board.groupBy("Date").agg(F.count(F.lit(1)).alias("articles"))


def sentiment_by_source(board: DataFrame) -> DataFrame:
    return (board.groupBy("Source").agg(F.avg("Article_Sentiment_Score").alias("mean"),
                                        F.count("Article_Sentiment_Score").alias("count")).orderBy("mean"))


def dashboard_headline(board: DataFrame) -> DataFrame:
    """Mean of the newest date and its change against the calendar day before (0 when that day is empty)."""
    daily = board.groupBy("Date").agg(F.avg("Article_Sentiment_Score").alias("mean"))
    # Daily rows only from here on: one partition is enough for a calendar of days.
    last = daily.agg(F.max("Date").alias("date"), F.max_by("mean", "Date").alias("mean"))
    before = daily.select(F.date_add("Date", 1).alias("date"), F.col("mean").alias("before"))
    score = settled(F.col("mean"), 2)
    return last.join(before, "date", "left").where("date IS NOT NULL").select(
        "date", score.alias("score"),
        F.coalesce(settled(score - F.col("before"), 2), F.lit(0.0)).alias("delta"))


# -- sentiment against prices ------------------------------------------------------------------
def next_day_pairs(daily: DataFrame, prices: DataFrame) -> DataFrame:
    """Sentiment of a day with the price change of the next *calendar* day; days before a closed day drop out."""
    change = prices.select(F.date_sub("trade_date", 1).alias("sentiment_date"), F.col("change").alias("next_day_change"))
    return daily.join(change, "sentiment_date").select("sentiment_date", "avg_sentiment", "next_day_change")


def sentiment_vs_next_day(mart: DataFrame, prices: DataFrame, today: Column, period: int = 30) -> DataFrame:
    rows = mart.where((F.col("summary_date") >= F.date_sub(today, period)) & F.col("avg_sentiment").isNotNull())
    daily = rows.groupBy(F.col("summary_date").alias("sentiment_date")).agg(
        weighted_avg(F.col("avg_sentiment"), F.col("scored_articles")).alias("avg_sentiment"))
    return next_day_pairs(daily, prices).orderBy("sentiment_date")


def sentiment_vs_next_day_market(posts: DataFrame, prices: DataFrame, market: str) -> DataFrame:
    """Article-level mean over the sources of one market. ``posts``: date, source_name, score."""
    daily = (posts.where(F.col("source_name").isin(config.crawled(market=market)) & F.col("score").isNotNull())
             .groupBy(F.col("date").alias("sentiment_date")).agg(F.avg("score").alias("avg_sentiment")))
    return next_day_pairs(daily, prices).orderBy("sentiment_date")


# -- prediction results ------------------------------------------------------------------------
def rebased_curve(curve: DataFrame, start: str, end: str) -> DataFrame:
    """Curves restarted at 1 on the first shown day. ``curve`` holds one row per market and day."""
    view = curve.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    w = Window.partitionBy("market").orderBy("date")
    based = lambda c: (F.col(c) / F.first(c).over(w)).alias(c)
    return view.select("market", "date", based("strategy_cumulative_return"), based("buy_and_hold_return"))
