"""Tables that are brought up to date batch by batch; each result has to be what one pass over everything gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import day, fx, query, ts
from catalog.landing import _fetches
from catalog.operations import staged
from catalog.quality import _REASONS, incoming
from catalog.tables import _FACT, _MARKET_SQL, _STG
from moodtide.operators import quality
from moodtide.plans import ingest, staging, warehouse
from moodtide.plans.ledger import FactLedger
from moodtide.session import shared_dir
from moodtide.sources import landing
from moodtide.sources.bodies import BodyStore
from moodtide.sources.domain import Desk
from moodtide.sources.keyed import KeyedTable
from moodtide.streaming import jobs

c = F.col
#: Rows of a landed file, at least, when a go writes several.
FILE_ROWS = 100_000


# -- keyed tables --------------------------------------------------------------------------------
def _deliveries(desk: Desk, of=None):
    """Parsed deliveries, or those whose raw rows ``of`` holds for."""
    raw = desk.raw_articles()
    rows = staging.extract_articles(raw if of is None else raw.where(of), ["title", "push_count"]).where("url IS NOT NULL")
    return rows.select("url", "raw_id", "source_name", "title", "push_count", "ingested_at")


def keyed_articles_table(desk: Desk) -> KeyedTable:
    """Three batches of deliveries, inserted if their address is unknown; the last one comes twice."""
    table = KeyedTable(desk.spark, shared_dir(desk.spark, "keyed"), ["url"], buckets=8, counter="raw_id")
    for number in (0, 1, 2, 2):
        table.insert_absent(_deliveries(desk, c("raw_id") % 3 == number), ["ingested_at", "raw_id"], sequence=number)
    return table


@query("keyed_articles", """
 SELECT url, raw_id, source_name, title, CAST(push_count AS BIGINT) AS push_count FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY raw_id % 3, ingested_at, raw_id) AS n FROM v_extracted WHERE url IS NOT NULL) WHERE n = 1""")
def keyed_articles(desk: Desk):
    return keyed_articles_table(desk).read().drop("ingested_at")


@query("keyed_new_urls", "SELECT DISTINCT url FROM v_extracted WHERE url IS NOT NULL AND CAST(split_part(url, '/a/', 2) AS BIGINT) % 4 = 0")
def keyed_new_urls(desk: Desk):
    """Addresses of a listing that no stored unit holds; the units' filters say which ones are read."""
    urls = _deliveries(desk).select("url").distinct()
    number = F.element_at(F.split("url", "/a/"), -1).cast("bigint")
    table = KeyedTable(desk.spark, shared_dir(desk.spark, "known"), ["url"], buckets=8)
    for part in (1, 2, 3):
        table.insert_absent(urls.where(number % 4 == part), ["url"])
    return table.absent(urls)


@query("keyed_scores", f"""
 SELECT article_id_raw, {fx("CASE WHEN n % 10 = 4 THEN score / 4 ELSE score END")} AS score, {ts("ingested_at")} AS first_at FROM (
  SELECT article_id_raw, CAST(split_part(article_id_raw, '/a/', 2) AS BIGINT) AS n, arg_max(CAST(score_text AS DOUBLE), raw_id) AS score, min(ingested_at) AS ingested_at
  FROM v_raw_scores GROUP BY 1, 2) WHERE n % 50 <> 0""")
def keyed_scores(desk: Desk):
    """Scores that come again keep their first time; then some are withdrawn and some are patched."""
    raw = desk.raw_scores()
    rows = raw.select("article_id_raw", F.get_json_object("raw_payload", "$.score").cast("double").alias("score"), c("ingested_at").alias("first_at"), "raw_id")
    table = KeyedTable(desk.spark, shared_dir(desk.spark, "scores"), ["article_id_raw"], buckets=8)
    for odd in (1, 0):  # first deliveries have odd ids
        table.upsert(rows.where(c("raw_id") % 2 == odd).drop("raw_id"), ["first_at"], keep=["first_at"])
    number = F.element_at(F.split("article_id_raw", "/a/"), -1).cast("bigint")
    table.delete(table.read().where(number % 50 == 0))
    table.patch(table.read().where(number % 10 == 4).select("article_id_raw", (c("score") / 4).alias("score")), ["score"])
    return table.read()


@query("incremental_snapshot", """
 SELECT stamp, count(*) AS n, CAST(sum(raw_id) AS BIGINT) AS ids FROM (
  SELECT 'first' AS stamp, raw_id FROM v_raw_sources WHERE raw_id % 5 <> 0 UNION ALL SELECT 'second', raw_id FROM v_raw_sources) GROUP BY 1""")
def incremental_snapshot(desk: Desk):
    """Two snapshots of a table that grew in between; the second one copies what is new."""
    rows, folder = desk.raw_sources().select("raw_id", "source_name"), shared_dir(desk.spark, "snapshots")
    table = KeyedTable(desk.spark, shared_dir(desk.spark, "snapped"), ["raw_id"], buckets=8)
    table.insert_absent(rows.where(c("raw_id") % 5 != 0), ["source_name"])
    table.snapshot(folder, "first")
    table.insert_absent(rows, ["source_name"])
    table.snapshot(folder, "second")
    of = lambda stamp: table.restored(folder, stamp).select(F.lit(stamp).alias("stamp"), "raw_id")
    return of("first").unionByName(of("second")).groupBy("stamp").agg(F.count(F.lit(1)).alias("n"), F.sum("raw_id").alias("ids"))


# -- bodies by content -----------------------------------------------------------------------------
@query("bodies_latest", """
 SELECT url, 'cnn' AS source, CASE WHEN starts_with(url, 'https') THEN '2024-01-03T00:00:00' WHEN contains(url, '?') THEN '2024-01-02T00:00:00'
   ELSE '2024-01-01T00:00:00' END AS fetched_at, CAST(200 AS BIGINT) AS http_status,
  CASE WHEN starts_with(url, 'https') THEN html || '<!-- again -->' ELSE html END AS raw_html,
  CASE WHEN contains(url, '?') THEN '{"page_id":' || page_id || '}' END AS raw_json FROM pages""")
def bodies_latest(desk: Desk):
    """Fetches landed in three batches, the newest one first and one of them twice."""
    store, fetched = BodyStore(desk.spark, shared_dir(desk.spark, "bodies"), buckets=4), landing.response_document(_fetches(desk))
    for at in ("2024-01-03", "2024-01-01", "2024-01-02", "2024-01-01"):
        store.store(fetched.where(c("fetched_at").startswith(at)))
    return store.documents()


@query("bodies_stored", """
 SELECT sha256(body) AS hash, CAST(length(body) AS BIGINT) AS size FROM (
  SELECT html AS body FROM pages UNION SELECT html || '<!-- again -->' FROM pages WHERE starts_with(url, 'https')
  UNION SELECT '{"page_id":' || page_id || '}' FROM pages WHERE contains(url, '?'))""")
def bodies_stored(desk: Desk):
    """Each body once, however often and under however many addresses it was fetched."""
    store, fetched = BodyStore(desk.spark, shared_dir(desk.spark, "bodies"), buckets=4), landing.response_document(_fetches(desk))
    store.store(fetched)
    store.store(fetched.withColumn("url", F.concat(c("url"), F.lit("#copy"))).withColumn("fetched_at", F.lit("2024-02-01T00:00:00")))
    return store.bodies.read().select("hash", F.length("body").alias("size"))


# -- quarantine --------------------------------------------------------------------------------------
@query("quarantine_rows", f"SELECT event_id, reasons FROM (SELECT event_id, {_REASONS} AS reasons FROM events) WHERE reasons <> ''")
def quarantine_rows(desk: Desk):
    """Rejected rows as they are read back, beside the valid ones that the same job wrote."""
    rows = quality.validate_articles(incoming(desk), F.lit("2024-01-29 00:00:00").cast("timestamp_ntz"))
    path = shared_dir(desk.spark, "quarantine")
    ingest.quarantine(rows, path)
    return ingest.rejected(desk.spark, path, rows.schema).select("event_id", "reasons")


# -- the ledger of the fact ----------------------------------------------------------------------------
def _ledger(desk: Desk) -> FactLedger:
    """Early rows with early scores, then late rows and corrected scores, then moved, withdrawn and unscored ones; the last batch comes twice."""
    book = FactLedger(desk.spark, shared_dir(desk.spark, "ledger"), buckets=8)
    articles, scores, i = desk.articles().select("article_id", "source_id", "published_at", "push_count"), desk.scores().select("article_id", "score"), c("article_id")
    book.apply(0, articles.where(i % 3 != 2), scores.withColumn("score", c("score") / 2))
    book.apply(1, articles.where(i % 3 == 2), scores)
    moved = articles.where(i % 10 == 0).withColumns({"source_id": (1 + c("source_id") % 5).cast("int"), "published_at": c("published_at") + F.expr("INTERVAL 1 DAY")})
    for _ in range(2):
        book.apply(2, moved, scores.where(i % 7 == 3).withColumn("score", F.lit(None).cast("double")), articles.where(i % 25 == 1).select("article_id"))
    return book


def _ledger_fact(desk: Desk):
    return _ledger(desk).fact(desk.sources(), warehouse.dim_source(desk.sources()))


@query("ledger_fact", f"SELECT {_FACT} FROM v_late_fact")
def ledger_fact(desk: Desk):
    return _ledger_fact(desk)


@query("ledger_daily_mart", f"""
 SELECT {day("summary_date")} AS summary_date, source_name, total_articles, scored_articles,
  CAST(avg_sentiment AS DOUBLE) AS avg_sentiment, CAST(avg_push_count AS DOUBLE) AS avg_push_count FROM v_late_mart""")
def ledger_daily_mart(desk: Desk):
    return warehouse.mart_daily_summary(_ledger_fact(desk))


@query("ledger_market_mart", _MARKET_SQL.replace("v_fact", "v_late_fact"))
def ledger_market_mart(desk: Desk):
    return warehouse.mart_market_summary(_ledger_fact(desk), warehouse.dim_source(desk.sources()), warehouse.dim_market(desk.spark))


# -- streams over several batches --------------------------------------------------------------------------
def _as_files(desk: Desk, rows, part, parts: int):
    """``rows`` written in ``parts`` goes, and a stream that takes what a go wrote as a batch: one file, or as many for each go as the smallest of them fills."""
    folder, whole = shared_dir(desk.spark, "landed"), shared_dir(desk.spark, "landing")
    rows.withColumn("_part", part).write.parquet(whole)
    made = desk.spark.read.parquet(whole)
    sizes = {r[0]: r[1] for r in made.groupBy("_part").count().collect()}  # a row for each go
    files = max(1, min(sizes.get(number, 0) for number in range(parts)) // FILE_ROWS)
    for number in range(parts):
        made.where(c("_part") == number).drop("_part").repartition(files).write.mode("append").parquet(folder)
    return desk.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


@query("stream_staging_folded", f"SELECT {_STG} FROM v_stg_articles")
def stream_staging_folded(desk: Desk):
    """Five batches with re-deliveries across them, folded in tiers on the way, then old folders removed."""
    log, checkpoint = shared_dir(desk.spark, "staging"), shared_dir(desk.spark, "checkpoint")
    jobs.publish_staging(_as_files(desk, desk.raw_articles(), c("raw_id") % 5, 5), log, checkpoint, fan=2)
    jobs.staging_log(desk.spark, log).clean(0)
    return staged(jobs.current_staging(desk.spark, log))


@query("stream_ledger", f"SELECT {_FACT} FROM v_late_fact")
def stream_ledger(desk: Desk):
    """The same changes as a stream of four batches, whichever comes first."""
    i = c("article_id")
    none = lambda kind: F.lit(None).cast(kind)
    articles = desk.articles().select(
        F.lit("article").alias("change"), "article_id", F.when(i % 10 == 0, 1 + c("source_id") % 5).otherwise(c("source_id")).cast("int").alias("source_id"),
        F.when(i % 10 == 0, c("published_at") + F.expr("INTERVAL 1 DAY")).otherwise(c("published_at")).alias("published_at"), c("push_count").cast("bigint").alias("push_count"),
        none("double").alias("score"), F.lit(1).alias("at")).where(i % 25 != 1)
    scores = desk.scores().select(F.lit("score").alias("change"), "article_id", none("int").alias("source_id"), none("timestamp_ntz").alias("published_at"),
                                  none("bigint").alias("push_count"), "score", F.lit(1).alias("at"))
    taken = scores.where(i % 7 == 3).withColumns({"score": none("double"), "at": F.lit(2)})
    changes = articles.unionByName(scores).unionByName(taken)
    part = F.when(c("at") == 2, 3).when(c("change") == "score", i % 2).otherwise(1 + i % 2)
    ledger, checkpoint = shared_dir(desk.spark, "ledger"), shared_dir(desk.spark, "checkpoint")
    jobs.post_changes(_as_files(desk, changes, part, 4), ledger, checkpoint)
    return FactLedger(desk.spark, ledger).fact(desk.sources(), warehouse.dim_source(desk.sources()))
