"""The daily fact kept as sums and counts that signed deltas change.

``posts`` holds what each article adds to its day and source now. A batch of new, moved, scored, re-scored and withdrawn articles reads the posts it touches, takes their
old share out and puts the new one in: the difference by day and source is the batch's delta, and only cells of the delta change in ``totals``. Sums are decimals, so what
was put in comes out whole.

A batch has a number. Its new posts and its delta are written down before either table changes; both tables note the number with the change. A batch that is lost at any
point comes again with its number and goes on from there, and one that was applied changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.functions.numbers import numeric
from moodtide.sources.keyed import KeyedTable

_SCORE, _SUM = "decimal(20,12)", "decimal(38,12)"
POSTS = f"article_id bigint, posted boolean, fact_date date, source_id int, push_count bigint, score {_SCORE}"
TOTALS = f"fact_date date, source_id int, article_count bigint, scored_articles bigint, score_sum {_SUM}, pushed_articles bigint, push_sum bigint"
_MEASURES = ["article_count", "scored_articles", "score_sum", "pushed_articles", "push_sum"]


class FactLedger:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.posts = KeyedTable(spark, f"{self.path}/posts", ["article_id"], buckets, schema=POSTS)
        self.totals = KeyedTable(spark, f"{self.path}/totals", ["fact_date", "source_id"], max(1, buckets // 8), schema=TOTALS)

    def next_sequence(self) -> int:
        return self.totals.sequence() + 1

    # -- a batch -----------------------------------------------------------------------------------
    def apply(self, sequence: int, articles: DataFrame | None = None, scores: DataFrame | None = None, withdrawn: DataFrame | None = None) -> None:
        """``articles`` (article_id, source_id, published_at, push_count) are new or changed, ``scores`` (article_id, score) new or changed, a null one takes the score back;
        ``withdrawn`` (article_id) are gone, and come back with the next article of their id. One row an id in each; a score may come before its article."""
        if self.totals.is_applied(sequence):
            return
        step = f"{self.path}/steps/sequence={sequence}"
        if "_SUCCESS" not in self.posts._names(f"{step}/delta"):
            self._write_step(step, articles, scores, withdrawn)
        self._put_in(step, sequence)

    def resume(self) -> None:
        """Put in a batch that was written down and then lost."""
        sequence = self.next_sequence()
        if "_SUCCESS" in self.posts._names(f"{self.path}/steps/sequence={sequence}/delta"):
            self._put_in(f"{self.path}/steps/sequence={sequence}", sequence)

    def _put_in(self, step: str, sequence: int) -> None:
        self.posts.upsert(self.spark.read.schema(POSTS).parquet(f"{step}/posts"), [F.lit(1)], sequence=sequence)
        self.totals.merge(self.spark.read.schema(TOTALS).parquet(f"{step}/delta"), self._added, sequence=sequence)
        for name in self.posts._names(f"{self.path}/steps"):
            if int(name.split("=")[1]) < sequence:
                self.posts._delete(f"{self.path}/steps/{name}")

    def _write_step(self, step: str, articles: DataFrame | None, scores: DataFrame | None, withdrawn: DataFrame | None) -> None:
        empty = self.spark.createDataFrame([], "article_id bigint, source_id int, published_at timestamp_ntz, push_count bigint, score double")
        came = (articles if articles is not None else empty).select(
            F.col("article_id").cast("bigint"), F.struct(F.to_date("published_at").alias("fact_date"), F.col("source_id").cast("int").alias("source_id"),
                                                         F.col("push_count").cast("bigint").alias("push_count")).alias("came"))
        rated = (scores if scores is not None else empty).select(F.col("article_id").cast("bigint"), F.struct(F.col("score").try_cast(_SCORE).alias("score")).alias("rated"))
        gone = (withdrawn if withdrawn is not None else empty).select(F.col("article_id").cast("bigint"), F.lit(True).alias("gone"))
        came.join(rated, "article_id", "full").join(gone, "article_id", "full").write.mode("overwrite").parquet(f"{step}/change")  # read several times
        change = self.spark.read.parquet(f"{step}/change")
        before = self.posts.known(change) if self.posts.exists() else self.posts.read([])
        both = change.join(before.select("article_id", F.struct("posted", "fact_date", "source_id", "push_count", "score").alias("old")), "article_id", "left")
        side = lambda c: F.when(F.col("came").isNotNull(), F.col(f"came.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
        new = both.select(
            "article_id", ((F.col("came").isNotNull() | F.coalesce("old.posted", F.lit(False))) & F.col("gone").isNull()).alias("posted"),
            side("fact_date"), side("source_id"), side("push_count"),
            F.when(F.col("rated").isNotNull(), F.col("rated.score")).otherwise(F.col("old.score")).alias("score"), "old")
        new.write.mode("overwrite").parquet(f"{step}/posts")
        new = self.spark.read.parquet(f"{step}/posts")
        shares = new.where("posted").select(*_share(1)).unionByName(new.where("old.posted").select("old.*").select(*_share(-1)))
        delta = shares.groupBy("fact_date", "source_id").agg(*[F.sum(m).alias(m) for m in _MEASURES])
        delta.where(" OR ".join(f"{m} <> 0" for m in _MEASURES)).select("fact_date", "source_id", *_typed()).write.mode("overwrite").parquet(f"{step}/delta")

    @staticmethod
    def _added(both: DataFrame) -> DataFrame:
        """Totals with a delta put in; a cell that has no article any more goes."""
        sums = [(F.coalesce(F.col(f"_old_{m}"), F.lit(0)) + F.col(m)).cast(_SUM if m == "score_sum" else "bigint").alias(m) for m in _MEASURES]
        return both.select("fact_date", "source_id", *sums).where("article_count <> 0")

    # -- what is read --------------------------------------------------------------------------------
    def fact(self, sources: DataFrame, dims: DataFrame) -> DataFrame:
        """The stored fact, as :func:`moodtide.plans.warehouse.fact_sentiment` makes it from all articles."""
        average = lambda top, n: F.try_divide(F.col(top).cast("decimal(38,12)"), F.col(n).cast("decimal(20,0)"))
        cells = self.totals.read().select(
            "fact_date", "source_id", "article_count", "scored_articles", numeric(average("score_sum", "scored_articles"), 6, 4).alias("avg_sentiment"),
            numeric(average("push_sum", "pushed_articles"), 8, 2).alias("avg_push_count"))
        named = cells.join(sources.select("source_id", "source_name"), "source_id")
        return named.join(dims.select("source_id", F.col("tracked_stock").alias("stock_symbol")), "source_id", "left").select(
            "fact_date", "source_id", "stock_symbol", "source_name", "article_count", "scored_articles", "avg_sentiment", "avg_push_count")

    def vacuum(self, grace_seconds: float) -> int:
        return self.posts.vacuum(grace_seconds) + self.totals.vacuum(grace_seconds)


def _share(sign: int) -> list[Column]:
    """What a post adds to its cell, or takes out of it."""
    scored, pushed = F.col("score").isNotNull().cast("bigint"), F.col("push_count").isNotNull().cast("bigint")
    of = {"article_count": F.lit(1).cast("bigint"), "scored_articles": scored, "score_sum": F.coalesce("score", F.lit(0)).cast(_SUM),
          "pushed_articles": pushed, "push_sum": F.coalesce("push_count", F.lit(0)).cast("bigint")}
    return [F.col("fact_date"), F.col("source_id"), *[(sign * c).cast(_SUM if m == "score_sum" else "bigint").alias(m) for m, c in of.items()]]


def _typed() -> list[Column]:
    return [F.col(m).cast(_SUM if m == "score_sum" else "bigint").alias(m) for m in _MEASURES]
