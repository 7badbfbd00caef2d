"""Upserts over immutable tables.

A merge gives the new content of the table as a DataFrame. Rows of the target that no update touches pass through an
anti join, so only the keys of the updates have to travel when they are few; Spark measures them at run time and
picks the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.operators.dedup import absent_from, latest
from moodtide.session import shared_dir


def insert_absent(target: DataFrame, updates: DataFrame, keys: Sequence[str], first_by: Sequence[str]) -> DataFrame:
    """Conflict rule "do nothing": known keys keep their row, of several new ones the first by ``first_by`` stays."""
    return target.unionByName(new_rows(target, updates, keys, first_by))


def new_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str], first_by: Sequence[str]) -> DataFrame:
    """The rows that ``insert_absent`` adds."""
    fresh = absent_from(updates, target, keys)
    rest = [c for c in updates.columns if c not in keys]
    return (fresh.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*first_by)).alias("_row"))
            .select(*keys, "_row.*").select(*updates.columns))


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
           keep: Sequence[str] = ()) -> DataFrame:
    """Conflict rule "overwrite": the latest update per key replaces the row, except for the columns in ``keep``."""
    wins = latest(updates, keys, order).select(*updates.columns)
    untouched = target.join(wins.select(*keys), list(keys), "left_anti")
    if keep:
        old = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in keep], F.lit(True).alias("_known"))
        wins = wins.join(old, list(keys), "left").select(*[
            F.when(F.col("_known"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in keep else F.col(c)
            for c in updates.columns])
    return untouched.unionByName(wins)


def patch(target: DataFrame, fixes: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Set only the fields a fix has a value for; ``fixes`` holds one row per key."""
    new = fixes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in fields])
    return target.join(new, list(keys), "left").select(*[
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in target.columns])


def write_version(df: DataFrame, folder: str, version: str, partition_by: Sequence[str] = ()) -> str:
    """Write the new content beside the old one; a reader moves over when the write is complete."""
    path = f"{folder.rstrip('/')}/version={version}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_partitions(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str], touched: Sequence | None = None) -> None:
    """Overwrite only the partitions present in ``df``, which may itself read from ``path``.

    ``touched`` are values of a single partition column that ``df`` was made for; those it has no row of any more lose their partition.

    The rows are first written to the shared folder: an executor lost half way then never leaves the target with
    partitions that are gone but not yet rewritten from themselves. The final write gathers small partitions into few
    files and splits a partition that holds far more rows than others over several tasks.
    """
    staging = shared_dir(spark, "staging")
    df.write.mode("overwrite").parquet(staging)
    (spark.read.schema(df.schema).parquet(staging)
     .hint("rebalance", *partition_by)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    if touched is not None:
        left = {r[0] for r in spark.read.schema(df.schema).parquet(staging).select(partition_by[0]).distinct().collect()}
        for value in set(touched) - left:
            _delete(spark, f"{path.rstrip('/')}/{partition_by[0]}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
    _delete(spark, staging)
