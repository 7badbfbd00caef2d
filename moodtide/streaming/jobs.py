"""Incremental jobs on Structured Streaming.

All run with ``availableNow``: the hourly schedule starts them, they take what has landed since and stop. Every batch
writes into its own ``batch_id=`` folder in overwrite mode, so a batch repeated after a lost driver or executor
replaces itself instead of doubling its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.operators import merge, monitoring
from moodtide.operators.dedup import absent_from, latest
from moodtide.plans import staging, warehouse
from moodtide.plans.ledger import FactLedger
from moodtide.session import shared_dir
from moodtide.sources.keyed import KeyedTable
from moodtide.streaming.folded import FoldedLog


def _run(stream: DataFrame, each_batch, checkpoint: str, mode: str = "append") -> None:
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(each_batch).start())
    query.awaitTermination()


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


# -- staging ---------------------------------------------------------------------------------------
def _newest(rows: DataFrame) -> DataFrame:
    """One row a URL: the latest delivery, with the smallest id of all. What came out once can go in again."""
    return latest(rows, ["url"], ["ingested_at", "raw_id", "_mark"], [F.min("first_raw_id").alias("_first")]).drop("first_raw_id").withColumnRenamed("_first", "first_raw_id")


def staging_log(spark: SparkSession, path: str, fan: int = 4) -> FoldedLog:
    return FoldedLog(spark, path, _newest, fan)


def publish_staging(raw: DataFrame, path: str, checkpoint: str, fan: int = 4) -> None:
    """Append the parsed deliveries of each batch to the staging log, already reduced to one row per URL.

    A late re-delivery forces no old file to be rewritten. After each batch the log is folded as far as its tiers ask for; ``current_staging`` folds what is left.
    """
    log = staging_log(raw.sparkSession, path, fan)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = staging.extract_articles(batch.withColumn("_mark", F.xxhash64("raw_payload")), keep=["_mark"]).where("url IS NOT NULL")
        log.write(rows.withColumn("first_raw_id", F.col("raw_id")), batch_id)
        log.compact()

    _run(raw, write, checkpoint)


def current_staging(spark: SparkSession, path: str) -> DataFrame:
    """Latest version per URL with its stable id; equals the batch staging of all raw rows."""
    return staging_log(spark, path).current().drop("_mark").withColumnRenamed("first_raw_id", "article_id")


# -- hourly counts -----------------------------------------------------------------------------------
def _added(counts: DataFrame) -> DataFrame:
    return counts.groupBy("hour", "source_name").agg(F.sum("new_articles").alias("new_articles"))


def hourly_ingest(raw: DataFrame, path: str, checkpoint: str) -> None:
    """Rows per source and hour of each batch. No state and no horizon: a row of any age counts in the batch that brings it."""
    log = FoldedLog(raw.sparkSession, path, _added)

    def write(batch: DataFrame, batch_id: int) -> None:
        log.write(monitoring.hourly_ingest(batch), batch_id)
        log.compact()

    _run(raw, write, checkpoint)


def current_hourly(spark: SparkSession, path: str) -> DataFrame:
    return FoldedLog(spark, path, _added).current()


# -- re-deliveries -----------------------------------------------------------------------------------
def first_deliveries(raw: DataFrame, path: str, checkpoint: str) -> None:
    """First delivery of every URL, however old it is: a batch is reduced to one row a URL and loses the URLs that are stored.

    Stored URLs are asked by their filters, so a batch of new ones reads next to none of them and adds its own rows only.
    """
    urls = raw.select(F.get_json_object("raw_payload", "$.url").alias("url"), "source_name", "raw_id",
                      F.col("ingested_at").cast("timestamp").alias("ingested_at")).where("url IS NOT NULL")
    table = first_seen(raw.sparkSession, path)
    _run(urls, lambda batch, batch_id: table.insert_absent(batch, ["ingested_at", "raw_id"], sequence=batch_id), checkpoint)


def first_seen(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, ["url"], schema="url string, source_name string, raw_id bigint, ingested_at timestamp")


# -- the fact from changes -------------------------------------------------------------------------------
def post_changes(changes: DataFrame, path: str, checkpoint: str) -> None:
    """Bring the ledger of the daily fact up to date with a stream of changes.

    ``change`` is ``article`` (source_id, published_at, push_count), ``score`` (score) or ``withdrawn``, for an ``article_id``; of several of one kind in a batch the last ``at``
    counts. A batch's number is the ledger's sequence, so a batch that comes again after a loss is put in once.
    """
    book = FactLedger(changes.sparkSession, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        one = latest(batch, ["article_id", "change"], ["at", F.xxhash64(*batch.columns)])
        of = lambda kind, *columns: one.where(F.col("change") == kind).select("article_id", *columns)
        book.apply(batch_id, of("article", "source_id", "published_at", "push_count"), of("score", "score"), of("withdrawn"))

    _run(changes, write, checkpoint)


# -- daily fact ----------------------------------------------------------------------------------------
def refresh_fact(articles: DataFrame, scores: DataFrame, sources: DataFrame, article_log: str, fact_path: str,
                 checkpoint: str, score_log: str | None = None) -> None:
    """Recompute only the days that are touched: days of new articles, days an article has left, and days of newly scored ones.

    ``articles`` is the stream; ``scores`` and ``sources`` are tables, read as of each batch. The scores a run has seen are noted in
    ``score_log``, so that the next run finds the new and the changed ones even when no article came.
    """
    spark = sources.sparkSession
    dims = warehouse.dim_source(sources)
    score_log = score_log or f"{article_log.rstrip('/')}-scores"
    done: set = set()

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("published_day", F.to_date("published_at"))
        one = rows.groupBy("article_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "article_id"]), F.xxhash64(*rows.columns)).alias("r"))
        one.select("article_id", "r.*").write.mode("overwrite").partitionBy("published_day").parquet(_batch_folder(article_log, batch_id))
        mine = _log(spark, article_log).where(F.col("batch_id") == batch_id).select("article_id")
        days = _days(_log(spark, article_log).join(mine, "article_id", "left_semi"))
        recompute_days(spark, article_log, scores, sources, dims, days, fact_path)
        done.update(days)

    _run(articles, write, checkpoint)
    if not _has_rows(spark, article_log):
        return
    now = scores.select("article_id", F.xxhash64("score").alias("mark"))
    new = absent_from(now, spark.read.parquet(score_log), ["article_id", "mark"]) if _has_rows(spark, score_log) else now
    folder = shared_dir(spark, "new-scores")
    new.write.parquet(folder)
    new = spark.read.parquet(folder)
    recompute_days(spark, article_log, scores, sources, dims, [d for d in days_of_scores(spark, article_log, new) if d not in done], fact_path)
    new.write.mode("append").parquet(score_log)


def _has_rows(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


_LOG_DAY = "published_day"


def _log(spark: SparkSession, article_log: str) -> DataFrame:
    """The article log with day and batch typed, whatever values its folders have."""
    rows = spark.read.parquet(article_log)
    return rows.withColumns({_LOG_DAY: F.col(_LOG_DAY).cast("date"), "batch_id": F.col("batch_id").cast("bigint")})


def _days(rows: DataFrame) -> list:
    """The days of the rows, null among them. A calendar has few, so they go to the driver and prune partitions from there."""
    return [r[0] for r in rows.select(_LOG_DAY).distinct().collect()]


def recompute_days(spark: SparkSession, article_log: str, scores: DataFrame, sources: DataFrame, dims: DataFrame,
                   days: list, fact_path: str) -> None:
    """Fact rows of the given days from the stored articles, replacing those days only; articles without a day are a day of their own.

    Days prune the stored articles by partition. Of an article that came again only the last version counts, whatever its day.
    """
    if not days:
        return
    log = _log(spark, article_log)
    known = [d for d in days if d is not None]
    in_days = F.col(_LOG_DAY).isin(known) if known else F.lit(False)
    stored = log.where(in_days | F.col(_LOG_DAY).isNull() if None in days else in_days)
    versions = log.select("article_id", "batch_id").join(stored.select("article_id"), "article_id", "left_semi")
    last = versions.groupBy("article_id").agg(F.max("batch_id").alias("batch_id"))
    fact = warehouse.fact_sentiment(stored.join(last, ["article_id", "batch_id"], "left_semi"), scores, sources, dims)
    merge.replace_partitions(spark, fact, fact_path, ["fact_date"], days)


def days_of_scores(spark: SparkSession, article_log: str, new_scores: DataFrame) -> list:
    """Days whose articles were scored since the last run."""
    return _days(_log(spark, article_log).join(new_scores.select("article_id"), "article_id", "left_semi"))
