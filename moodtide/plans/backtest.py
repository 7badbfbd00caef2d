"""Daily features, walk-forward folds and back-test figures.

Posts are aggregated to one row per market and day before any window runs, and every window is partitioned by market.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide import config

# --- fixed values --------------------------------------------------------------
FEATURES = ["avg_sentiment", "sentiment_yesterday", "sentiment_3day_avg", "avg_push_count",
            "push_count_3day_avg", "article_count", "article_count_3day_avg"]
FOLD_MONTHS, MIN_TRAIN_MONTHS = 3, 3
MIN_DAYS = 20 * MIN_TRAIN_MONTHS
# --------------------------------------------------------------------------------


def daily_base(posts: DataFrame) -> DataFrame:
    """Mean score, posts and mean votes (missing votes as 0) per market and day.

    Archive back-fills belong to no market here. ``posts``: date, source_name, score, push_count.
    """
    markets = {n: s["market"] for n, s in config.SOURCES.items()}
    return (posts.withColumn("market", config.lookup(F.col("source_name"), markets)).where("market IS NOT NULL")
            .groupBy("market", "date")
            .agg(F.avg("score").alias("avg_sentiment"), F.count(F.lit(1)).alias("article_count"),
                 F.avg(F.coalesce("push_count", F.lit(0))).alias("avg_push_count")))


def features(base: DataFrame, returns: DataFrame) -> DataFrame:
    """Same-day join with the market's instrument, then lag and trailing means over the *joined* days."""
    instrument = config.lookup(F.col("market"), config.MARKET_INSTRUMENT)
    prices = returns.select("symbol", F.col("trade_date").alias("date"), "close", "next_return", "next_day_up")
    joined = base.withColumn("symbol", instrument).join(prices, ["symbol", "date"])
    by_day = Window.partitionBy("market").orderBy("date")
    before = by_day.rowsBetween(-3, -1)

    def trailing(c: str) -> Column:
        return F.when(F.count(c).over(before) == 3, F.avg(c).over(before))

    out = joined.select(
        "market", "date", "close", "next_return", "next_day_up", "avg_sentiment", "article_count", "avg_push_count",
        F.lag("avg_sentiment").over(by_day).alias("sentiment_yesterday"),
        trailing("avg_sentiment").alias("sentiment_3day_avg"),
        trailing("avg_push_count").alias("push_count_3day_avg"),
        trailing("article_count").alias("article_count_3day_avg"))
    return out.dropna()


def prediction_gate(base: DataFrame, returns: DataFrame, feats: DataFrame) -> DataFrame:
    """Why a market gets no prediction, or ``ready``; from counts only."""
    markets = F.explode(F.array(*[F.lit(m) for m in config.MARKET_INSTRUMENT]))
    one = base.sparkSession.range(1).select(markets.alias("market"))
    mood = base.groupBy("market").agg(F.count(F.lit(1)).alias("sentiment_days"),
                                      F.count("avg_sentiment").alias("scored_days"))
    symbols = {s: m for m, s in config.MARKET_INSTRUMENT.items()}
    priced = (returns.groupBy(config.lookup(F.col("symbol"), symbols).alias("market"))
              .agg(F.count(F.lit(1)).alias("price_days")))
    usable = feats.groupBy("market").agg(F.count(F.lit(1)).alias("feature_days"))
    counts = one.join(mood, "market", "left").join(priced, "market", "left").join(usable, "market", "left").na.fill(0)
    state = (F.when(F.col("sentiment_days") == 0, "no_sentiment").when(F.col("scored_days") == 0, "no_scores")
             .when(F.col("price_days") == 0, "no_prices").when(F.col("feature_days") < MIN_DAYS, "too_few_days")
             .otherwise("ready"))
    return counts.withColumn("state", state)


def fold_starts(feats: DataFrame) -> DataFrame:
    """First test day of every fold as one array per market.

    The first is three months after the first day. Every bound is the one before plus three months, so a month end
    that was cut short (Nov 30 -> Feb 28) stays so.
    """
    span = feats.groupBy("market").agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    folds = F.ceil(F.months_between("last_day", "first_day") / FOLD_MONTHS).cast("int") + 1
    starts = F.aggregate(
        F.sequence(F.lit(1), folds),
        F.array(F.add_months("first_day", MIN_TRAIN_MONTHS)),
        lambda acc, _: F.array_append(acc, F.add_months(F.element_at(acc, -1), FOLD_MONTHS)))
    return span.select("market", F.filter(starts, lambda d: d < F.col("last_day")).alias("starts"))


def with_folds(feats: DataFrame) -> DataFrame:
    """Each day with the fold that tests it (0 = only ever trained on) and its number within the market.

    The fold is looked up in the market's own array of bounds: no day meets another day or fold row.
    """
    by_day = Window.partitionBy("market").orderBy("date")
    return (feats.join(fold_starts(feats), "market")
            .withColumn("fold", F.size(F.filter("starts", lambda d: d <= F.col("date"))))
            .withColumn("day_no", F.row_number().over(by_day)))


def walk_forward_folds(feats: DataFrame) -> DataFrame:
    """Folds with their train and test sizes; folds without test days do not appear."""
    days = with_folds(feats).where("fold > 0")
    start = F.get("starts", F.col("fold") - 1)
    return (days.groupBy("market", (F.col("fold") - 1).alias("fold"), start.alias("train_end"),
                         F.add_months(start, FOLD_MONTHS).alias("test_end"))
            .agg(F.count(F.lit(1)).alias("test_days"), (F.min("day_no") - 1).alias("train_days"))
            .where("train_days > 0"))


def backtest_curve(predictions: DataFrame) -> DataFrame:
    """Strategy (in the market only when ``pred`` = 1) against buy and hold.

    ``predictions``: market, date, close, next_return, true, pred.
    """
    w = Window.partitionBy("market").orderBy("date")
    daily = F.col("next_return") * (F.col("pred") == 1).cast("double")
    return (predictions.withColumn("strategy_daily_return", daily)
            .withColumn("strategy_cumulative_return",
                        F.product(F.lit(1.0) + F.col("strategy_daily_return")).over(w))
            .withColumn("buy_and_hold_return", F.col("close") / F.first("close").over(w)))


def backtest_summary(curve: DataFrame) -> DataFrame:
    end = lambda c: F.max_by(c, "date")
    return curve.groupBy("market").agg(
        F.avg((F.col("true") == F.col("pred")).cast("double")).alias("accuracy"),
        end("strategy_cumulative_return").alias("strategy_cumulative_return"),
        end("buy_and_hold_return").alias("buy_and_hold_return"),
        F.count(F.lit(1)).alias("sample_days"),
    ).withColumn("excess_return", F.col("strategy_cumulative_return") - F.col("buy_and_hold_return"))
