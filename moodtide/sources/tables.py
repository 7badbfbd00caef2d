"""Table input and output: parquet folders, relational databases, exports and snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Parquet table whose files may have grown columns over time; missing ones get their default."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    for name, value in (defaults or {}).items():
        df = df.withColumn(name, F.coalesce(name, F.lit(value)) if name in df.columns else F.lit(value))
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int,
              properties: Mapping[str, str]) -> DataFrame:
    """Relational table read in ``parts`` key ranges at a time."""
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table)
            .option("partitionColumn", key).option("lowerBound", low).option("upperBound", high)
            .option("numPartitions", parts).options(**properties).load())


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append",
               batch: int = 10_000) -> None:
    """Batched inserts; ``overwrite`` truncates and keeps the table's definition."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch)
     .option("truncate", "true").options(**properties).mode(mode).save())


def export_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Write each table anew, replacing an earlier export."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def snapshot_tables(tables: Mapping[str, DataFrame], folder: str, stamp: str) -> str:
    """Full copy of all tables under a time stamp; an existing snapshot is never touched."""
    path = f"{folder.rstrip('/')}/snapshot={stamp}"
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
    return path


def table_sizes(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """Row counts of written tables."""
    out = None
    for name in names:
        one = spark.read.parquet(f"{folder.rstrip('/')}/{name}").agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        out = one if out is None else out.unionByName(one)
    return out


def write_clustered(df: DataFrame, path: str, by: str, files: int) -> None:
    """Physical order by a column: each file covers one range of it, so that min/max statistics skip files."""
    df.repartitionByRange(files, by).sortWithinPartitions(by).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Catalog table bucketed by its join key: articles and scores bucketed alike join without a shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
