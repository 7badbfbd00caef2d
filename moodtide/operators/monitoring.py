"""Operating figures from the article table and the run and request logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide import config

# --- fixed values: upper bounds of the latency histogram, in seconds ---------------
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]
# -----------------------------------------------------------------------------------


def table_gauges(articles: DataFrame, scores: DataFrame, sources: DataFrame) -> DataFrame:
    """Current number of articles and mean score, per market and in all."""
    per_source = (articles.select("article_id", "source_id").join(scores.select("article_id", "score"), "article_id", "left")
                  .groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.count("score").alias("k"),
                                            F.sum("score").alias("s")))
    markets = per_source.join(sources.select("source_id", "source_name"), "source_id").groupBy(
        config.market_for_source(F.col("source_name")).alias("market")).agg(
        F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("s").alias("s"))
    total = markets.agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("s").alias("s")).select(
        F.lit("ALL").alias("market"), "n", "k", "s")
    return markets.unionByName(total).select(
        "market", F.col("n").alias("article_count"), F.try_divide("s", F.col("k").cast("double")).alias("sentiment_avg"))


def hourly_ingest(raw: DataFrame) -> DataFrame:
    """New raw rows per source and hour."""
    return raw.groupBy(F.window(F.col("ingested_at"), "1 hour").alias("w"), "source_name").agg(
        F.count(F.lit(1)).alias("new_articles")).select(
        F.col("w.start").alias("hour"), "source_name", "new_articles")


def step_times(log: DataFrame, every: str = "5 minutes") -> DataFrame:
    return log.groupBy(F.window("ts", every).alias("w"), "step").agg(F.avg("seconds").alias("mean_seconds")).select(
        F.col("w.start").alias("window_start"), "step", "mean_seconds")


def failure_ratio(log: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("status") == "failure")
    counted = F.count_if(F.col("status").isin("failure", "success"))
    return log.agg(failed.alias("failures"), counted.alias("runs"),
                   F.try_divide(failed.cast("double"), counted.cast("double")).alias("failure_ratio"))


def _quantile(q: float, counts: list[Column]) -> Column:
    """Linear interpolation inside the first bucket whose running count reaches ``q`` of all requests."""
    rank = F.lit(q) * counts[-1]
    value = F.lit(LATENCY_BOUNDS[-1])  # beyond the last finite bound
    for i in reversed(range(len(LATENCY_BOUNDS))):
        low = 0.0 if i == 0 else LATENCY_BOUNDS[i - 1]
        below = F.lit(0) if i == 0 else counts[i - 1]
        inside = F.lit(low) + F.lit(LATENCY_BOUNDS[i] - low) * (rank - below) / F.nullif(counts[i] - below, F.lit(0))
        value = F.when(counts[i] >= rank, F.coalesce(inside, F.lit(low))).otherwise(value)
    return value


def latency_quantiles(log: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99),
                      every: str = "5 minutes") -> DataFrame:
    """Latency quantiles per endpoint from a histogram.

    A request only adds to bucket counts. The counts of a window are a fixed 15 numbers however many requests it had,
    and partial counts of the input partitions add up.
    """
    s = F.col("seconds")
    counts = [F.count_if(s <= b).alias(f"le_{i}") for i, b in enumerate(LATENCY_BOUNDS)] + [
        F.count(F.lit(1)).alias(f"le_{len(LATENCY_BOUNDS)}")]
    grouped = log.groupBy(F.window("ts", every).alias("w"), "endpoint").agg(*counts)
    cum = [F.col(f"le_{i}") for i in range(len(LATENCY_BOUNDS) + 1)]
    return grouped.select(F.col("w.start").alias("window_start"), "endpoint",
                          *[_quantile(q, cum).alias(f"p{round(q * 100)}") for q in quantiles])


def freshness(raw: DataFrame, as_of: Column, stale_after: str = "INTERVAL 1 HOUR") -> DataFrame:
    """Newest delivery per source; stale when it is older than the limit."""
    last = raw.groupBy("source_name").agg(F.max("ingested_at").alias("newest"))
    return last.withColumn("stale", F.col("newest") < as_of - F.expr(stale_after))
