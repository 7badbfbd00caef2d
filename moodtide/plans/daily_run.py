"""The scheduled run: steps in order, with the rule which failures stop it."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide import config
from moodtide.functions import pii
from moodtide.operators import prices, quality
from moodtide.plans import backtest, ingest, labeling, learning, repair, warehouse
from moodtide.plans.ledger import FactLedger
from moodtide.sources import landing
from moodtide.sources.keyed import KeyedTable
from moodtide.sources.lake import KEYED, Lake
from moodtide.sources.tables import snapshot_tables

log = logging.getLogger(__name__)

# --- fixed values: steps of a run and whether their failure ends it -----------------
STEPS = {"schema": True, "extract": False, "transform": True, "pii": False, "score": False, "dw_etl": True,
         "backup": False, "predict": False}
# -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class StepResult:
    step: str
    status: str
    seconds: float
    error: str | None = None
    started: datetime | None = None


class RunAborted(RuntimeError):
    def __init__(self, results: Sequence[StepResult]):
        super().__init__(f"step {results[-1].step} failed: {results[-1].error}")
        self.results = list(results)


def run(steps: dict[str, Callable[[], object]]) -> list[StepResult]:
    """Run the given steps in their listed order. A failed optional step is logged and passed over."""
    results: list[StepResult] = []
    for name, required in STEPS.items():
        if name not in steps:
            continue
        start, at = time.monotonic(), datetime.now(timezone.utc).replace(tzinfo=None)
        try:
            steps[name]()
            results.append(StepResult(name, "success", time.monotonic() - start, None, at))
        except Exception as error:  # a step may fail in any way; the rule below decides
            results.append(StepResult(name, "failure", time.monotonic() - start, str(error), at))
            if required:
                raise RunAborted(results) from error
            log.warning("step %s failed, run goes on: %s", name, error)
    return results


def run_log(spark: SparkSession, results: Sequence[StepResult]) -> DataFrame:
    """Step results as rows of the run log that monitoring reads."""
    return spark.createDataFrame([(r.started, r.step, r.status, r.seconds, r.error) for r in results],
                                 "ts timestamp_ntz, step string, status string, seconds double, error string")


def run_logged(lake: Lake, steps: dict[str, Callable[[], object]]) -> list[StepResult]:
    """:func:`run`, with its log appended to the lake's ``run_log`` however the run ends."""
    try:
        results = run(steps)
    except RunAborted as aborted:
        lake.append("run_log", run_log(lake.spark, aborted.results))
        raise
    lake.append("run_log", run_log(lake.spark, results))
    return results


# -- the steps over a lake ------------------------------------------------------------------------
# Tables a snapshot holds.
_SAVED = ["articles", "comments", "sentiment_scores", "prices", "fact_sentiment", "mart_daily_summary", "mart_market_summary"]
_LEDGER_NOTES = "sequence bigint, articles bigint, scores bigint"


def scheduled(lake: Lake, landed: DataFrame, now: datetime, scorer: learning.Scorer | None = None, price_history: DataFrame | None = None) -> list[StepResult]:
    """One run with its log."""
    return run_logged(lake, lake_steps(lake, landed, now, scorer, price_history))


def lake_steps(lake: Lake, landed: DataFrame, now: datetime, scorer: learning.Scorer | None = None,
               price_history: DataFrame | None = None) -> dict[str, Callable[[], object]]:
    """The steps of a run over the landed bodies (source, kind, url, fetched_at, http_status, content_type, body).

    ``price_history`` (symbol, trade_date, close) is merged into the lake's prices. What a run writes goes by what it brings: rows of articles, comments, scores, prices and
    bodies are merged by key, and the fact takes the difference. A step that was lost begins again and ends as if it had run once.
    """
    spark, stamp = lake.spark, F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")

    def schema() -> None:
        if not lake.exists("sources"):
            rows = [(i, name, s["url"], s.get("has_push_count", False)) for i, (name, s) in enumerate(config.ALL_SOURCES.items(), 1)]
            lake.replace("sources", config.constant_frame(
                spark, rows, "source_id int, source_name string, url string, has_push_count boolean"))
        for name in KEYED:
            lake.table(name).create()

    def extract() -> None:
        if price_history is not None:
            load_prices(lake.table("prices"), price_history)
        lake.bodies().store(landing.response_document(landed))
        ingest.unread(landed).withColumn("run_at", stamp).write.mode("overwrite").parquet(f"{lake.path('unread')}/run={now:%Y%m%d%H%M%S}")
        # What was parsed is written once, with pseudonyms; rejected rows stay beside the valid ones, with their reasons.
        rows = ingest.masked(ingest.routed(landed, stamp))
        found, seen = ingest.quarantine(rows, f"{lake.path('scraped')}/run={now:%Y%m%d%H%M%S}")
        log.info("articles by outcome: %s", seen)
        landing.append(landing.raw_articles(found, F.col("source_name"), stamp), lake.path("raw_articles"))
        articles, comments = lake.table("articles"), lake.table("comments")
        first = articles.top() + 1
        lake.replace("new_articles", ingest.new_articles(found, articles.known(found), lake.read("sources"), first, stamp))
        fresh = lake.read("new_articles")
        # Comments go first: articles make an address known, and a run that ends in between must find it unknown again.
        # Comments of ids that no article has are what such a run left behind.
        if comments.top() >= first:
            comments.delete(comments.read().where(F.col("article_id") >= first))
        comments.upsert(ingest.new_comments(fresh), [F.lit(1)])
        articles.insert_absent(fresh.drop("comments"), ["article_id"])

    def checks(articles: DataFrame) -> DataFrame:
        price = lake.read("prices")
        one = lambda market: price.where(F.col("symbol") == config.MARKET_INSTRUMENT[market])
        return quality.table_checks(articles, lake.read("comments"), lake.read("sentiment_scores"), lake.read("sources"),
                                    one("TW"), one("US"))

    def transform() -> None:
        repair.check_and_mend(lake.table("articles"), lake.read("sources"), lake.bodies(), checks)
        report = quality.expectations(lake.read("articles"), lake.read("sources"),
                                      lake.read("prices").where(F.col("symbol") == config.MARKET_INSTRUMENT["US"]))
        lake.replace("expectations", report)

    def mask() -> None:
        """New rows are written with pseudonyms; rows that older runs wrote with names are found and patched."""
        for name in ("articles", "comments"):
            table = lake.table(name)
            author = pii.mask_author(F.col("author"))
            named = table.read().where(~F.col("author").eqNullSafe(author)).select(*table.keys, author.alias("author"))
            table.patch(named, ["author"])

    def score() -> None:
        if scorer is None:
            raise RuntimeError("no scorer given")
        articles, scores = lake.table("articles"), lake.table("sentiment_scores")
        # Which articles are open is seen from ids alone; texts are read from the units that hold open ones.
        todo = labeling.unscored(articles.read().select("url", "article_id"), scores.read())
        new = learning.score_articles(articles.known(todo), scores.read(), scorer, stamp)
        scores.upsert(new, ["calculated_at"], keep=["calculated_at"])

    def dw_etl() -> None:
        sources = lake.read("sources")
        dims = warehouse.dim_source(sources)
        for name, df in (("dim_market", warehouse.dim_market(spark)), ("dim_stock", warehouse.dim_stock(spark)), ("dim_source", dims)):
            lake.replace(name, df)
        book = FactLedger(spark, lake.path("ledger"), lake.buckets)
        notes = spark.read.schema(_LEDGER_NOTES).parquet(lake.path("ledger_notes")).orderBy(F.desc("sequence")).head() if lake.exists("ledger_notes") else None
        book.resume()
        articles, scores, sequence = lake.table("articles"), lake.table("sentiment_scores"), book.next_sequence()
        came, rated, gone, unrated = ledger_changes(book, articles, scores, notes.articles if notes else 0, notes.scores if notes else 0)
        book.apply(sequence, came.select("article_id", "source_id", "published_at", "push_count"),
                   rated.select("article_id", "score").unionByName(unrated.select("article_id", F.lit(None).cast("double").alias("score"))), gone)
        spark.createDataFrame([(sequence, articles.version(), scores.version())], _LEDGER_NOTES).write.mode("append").parquet(lake.path("ledger_notes"))
        lake.replace("fact_sentiment", book.fact(sources, dims))
        fact = lake.read("fact_sentiment")
        lake.replace("mart_daily_summary", warehouse.mart_daily_summary(fact))
        lake.replace("mart_market_summary", warehouse.mart_market_summary(fact, dims, warehouse.dim_market(spark)))

    def backup() -> dict[str, int]:
        """Units that no earlier snapshot holds are copied; the sources are a few rows."""
        at = now.strftime("%Y%m%d%H%M%S")
        snapshot_tables({"sources": lake.read("sources")}, lake.path("backup"), at)
        return {name: lake.table(name).snapshot(f"{lake.path('backup')}/{name}", at) for name in _SAVED}

    def predict() -> None:
        posts = (lake.read("articles").join(lake.read("sources").select("source_id", "source_name"), "source_id")
                 .join(lake.read("sentiment_scores").select("article_id", "score"), "article_id", "left")
                 .select(F.to_date("published_at").alias("date"), "source_name", "score", "push_count"))
        base, returns = backtest.daily_base(posts), prices.next_day_returns(lake.read("prices"))
        feats = backtest.features(base, returns)
        ready = backtest.prediction_gate(base, returns, feats).where("state = 'ready'").select("market")
        predictions = learning.walk_forward_predict(feats.join(ready, "market", "left_semi"))
        lake.replace("predictions", predictions)
        lake.append("prediction_runs", learning.prediction_run(learning.prediction_summary(lake.read("predictions")), stamp))

    return {"schema": schema, "extract": extract, "transform": transform, "pii": mask, "score": score, "dw_etl": dw_etl,
            "backup": backup, "predict": predict}


def ledger_changes(book: FactLedger, articles: KeyedTable, scores: KeyedTable, articles_at: int, scores_at: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Articles and scores that came or changed since the versions the ledger was brought to, ids that went, and ids whose score went.

    Where such a version is not there any more, all rows count as changed and what went is found by comparing ids.
    """
    posts = book.posts.read()
    came, urls = articles.changes(articles_at)
    if articles_at in articles.versions():
        old = articles.read(version=articles_at).select(F.col("url").alias("_url"), "article_id")
        gone = urls.join(old, F.col("url").eqNullSafe(F.col("_url"))).select("article_id")
    else:
        gone = posts.where("posted").select("article_id").join(articles.read().select("article_id"), "article_id", "left_anti")
    rated, unrated = scores.changes(scores_at)
    if scores_at not in scores.versions():
        unrated = posts.where("score IS NOT NULL").select("article_id").join(scores.read().select("article_id"), "article_id", "left_anti")
    return came, rated, gone, unrated


def load_prices(table: KeyedTable, history: DataFrame) -> None:
    """Merge fetched closes (symbol, trade_date, close); the first fetched day takes its change from the day that is stored before it."""
    new = history.groupBy("symbol", "trade_date").agg(F.max("close").alias("close"))
    stored = table.read().select("symbol", "trade_date", "close").join(new.select("symbol", "trade_date"), ["symbol", "trade_date"], "left_anti")
    changed = prices.with_changes(stored.unionByName(new.select("symbol", "trade_date", F.col("close").cast("decimal(10,2)").alias("close"))))
    table.upsert(changed, [F.lit(1)])
