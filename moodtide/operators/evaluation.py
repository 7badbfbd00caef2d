"""Classification figures from (true, pred) pairs; one aggregation, then arithmetic on at most classes² rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_matrix(pairs: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Count of every (true, pred) pair, zero for the pairs that do not occur."""
    grid = (pairs.sparkSession.range(1)
            .select(F.explode(F.array(*[F.lit(c) for c in classes])).alias("true"))
            .select("true", F.explode(F.array(*[F.lit(c) for c in classes])).alias("pred")))
    seen = pairs.groupBy("true", "pred").agg(F.count(F.lit(1)).alias("n"))
    return grid.join(seen, ["true", "pred"], "left").select("true", "pred", F.coalesce("n", F.lit(0)).alias("n"))


def class_report(pairs: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Precision, recall, F1 and support per class; undefined ratios are 0."""
    cells = confusion_matrix(pairs, classes)
    hit = F.col("true") == F.col("pred")
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("true").alias("label"), F.when(hit, F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("bigint").alias("tp"),
                 F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted")))).alias("s")).select("s.*")
    total = sides.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                       F.sum("predicted").alias("predicted"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    p, r = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    return total.select("label", p.alias("precision"), r.alias("recall"), ratio(2 * p * r, p + r).alias("f1"),
                        "support", "tp")


def overall(report: DataFrame) -> DataFrame:
    """Accuracy and macro-F1 of a class report."""
    return report.agg(F.try_divide(F.sum("tp").cast("double"), F.sum("support").cast("double")).alias("accuracy"),
                      F.avg("f1").alias("macro_f1"), F.sum("support").alias("samples"))


def label_progress(labels: DataFrame, classes: Sequence[str], target: int) -> DataFrame:
    """Labels collected per class, zero for a class without any, and the share of the target reached in all."""
    want = labels.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in classes])).alias("label"))
    have = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    out = want.join(have, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("labeled"))
    total = labels.agg(F.count(F.lit(1))).scalar()
    return out.withColumn("progress", F.least(F.lit(1.0), total / F.lit(float(target))))
