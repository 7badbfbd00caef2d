"""Connected components of a link table by alternating large and small stars; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.session import shared_dir


def _written(df: DataFrame, folder: str, name: str) -> tuple[DataFrame, tuple]:
    df.write.parquet(f"{folder}/{name}")
    kept = df.sparkSession.read.parquet(f"{folder}/{name}")
    mark = kept.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return kept, tuple(mark)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link, from rows ``(a, b)`` of one ordered type; the root is the smallest node reachable.

    A large star hands the larger neighbours of a node to its smallest one, a small star the smaller ones. Both are a
    hash aggregate for the smallest neighbour and a join back to the links, in which Spark can split the rows of a hub. The
    number of rounds grows with the logarithm of the length of a chain. Links with a null end and loops are no links.
    """
    folder = shared_dir(links.sparkSession, "components")
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, mark = _written(pairs, folder, "0")
    step = 0
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        step += 1
        large, _ = _written(large, folder, str(step))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(
            smallest.select("u", F.col("m").alias("v"))).distinct()
        step += 1
        edges, now = _written(small, folder, str(step))
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
