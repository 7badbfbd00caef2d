"""Price history: one row per instrument and trading day, so windows stay small whatever the article volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _by_day():
    return Window.partitionBy("symbol").orderBy("trade_date")


def with_changes(prices: DataFrame) -> DataFrame:
    """Close and its change against the trading day before; the first day has none."""
    close = F.col("close").cast("decimal(10,2)")
    return prices.select("symbol", "trade_date", close.alias("close"),
                         (close - F.lag(close).over(_by_day())).cast("decimal(10,2)").alias("change"))


def between(prices: DataFrame, symbol: str, start: str, end: str) -> DataFrame:
    """Days from ``start`` up to, not including, ``end``."""
    day = F.col("trade_date")
    return (prices.where((F.col("symbol") == symbol) & (day >= F.lit(start).cast("date"))
                         & (day < F.lit(end).cast("date"))).orderBy("trade_date"))


def next_day_returns(prices: DataFrame) -> DataFrame:
    """Return to the next trading day and whether it is up; the last day drops out."""
    close = F.col("close").cast("double")
    after = F.lead(close).over(_by_day())
    out = prices.select("symbol", "trade_date", close.alias("close"), ((after - close) / close).alias("next_return"))
    return out.where("next_return IS NOT NULL").withColumn("next_day_up", (F.col("next_return") > 0).cast("int"))
