"""Keep one row per key.

All of them are aggregations rather than windows: a key that was delivered very often is reduced inside each input
partition first, so it never arrives as one huge group in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _struct(columns: Sequence[str | Column]) -> Column:
    return F.struct(*columns)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
           extra: Sequence[Column] = ()) -> DataFrame:
    """Row with the largest ``order`` per key; ``extra`` are further aggregates over all deliveries."""
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(F.max_by(_struct(rest), _struct(order)).alias("_row"), *extra)
    return grouped.select(*keys, "_row.*", *[c for c in grouped.columns if c not in keys and c != "_row"])


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Row with the smallest ``order`` per key."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min_by(_struct(rest), _struct(order)).alias("_row"))
            .select(*keys, "_row.*"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def absent_from(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``known``. Never NOT IN: one null there would empty the result.

    Known keys are first cut down to those of ``df``: when ``df`` is a small batch Spark broadcasts its keys there, and the known side is
    read but not shuffled.
    """
    mine = df.select(*keys).distinct()
    return df.join(known.select(*keys).join(mine, list(keys), "left_semi"), list(keys), "left_anti")
