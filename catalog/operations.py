"""Monitoring, exports, crawl calendar and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import day, fx, query, ts
from catalog.tables import _FACT, _STG
from moodtide import config
from moodtide.functions import pii
from moodtide.operators import monitoring
from moodtide.session import shared_dir
from moodtide.sources import feeds, tables
from moodtide.sources.domain import SOURCE_IDS, SOURCE_ROWS, Desk
from moodtide.streaming import jobs

c = F.col


# -- monitoring ----------------------------------------------------------------------------------
@query("pipeline_gauges", f"""
 SELECT coalesce(market_code, 'ALL') AS market, count(*) AS article_count, {fx("avg(score)")} AS sentiment_avg
 FROM v_articles a LEFT JOIN v_scores s ON s.article_id = a.article_id GROUP BY ROLLUP (market_code)""")
def pipeline_gauges(desk: Desk):
    return monitoring.table_gauges(desk.articles(), desk.scores(), desk.sources())


_HOURLY = f"""SELECT {ts("date_trunc('hour', ingested_at)")} AS hour, source_name, count(*) AS new_articles FROM v_raw_articles GROUP BY 1, 2"""


@query("ingest_rate_hourly", _HOURLY)
def ingest_rate_hourly(desk: Desk):
    return monitoring.hourly_ingest(desk.raw_articles())


@query("step_time_avg", f"""
 SELECT {ts("time_bucket(INTERVAL 5 MINUTE, ts)")} AS window_start, event_type AS step, {fx("avg(value / 100)")} AS mean_seconds
 FROM events GROUP BY 1, 2""")
def step_time_avg(desk: Desk):
    return monitoring.step_times(desk.run_log())


@query("failure_ratio", f"""
 SELECT count(*) FILTER (WHERE event_type = 'error') AS failures, count(*) AS runs,
  {fx("count(*) FILTER (WHERE event_type = 'error') / count(*)")} AS failure_ratio FROM events""")
def failure_ratio(desk: Desk):
    return monitoring.failure_ratio(desk.run_log())


_BOUNDS = monitoring.LATENCY_BOUNDS


def _quantile_sql(q: float) -> str:
    whens = []
    for i, b in enumerate(_BOUNDS):
        low, below = (0.0, "0") if i == 0 else (_BOUNDS[i - 1], f"c{i - 1}")
        whens.append(f"WHEN c{i} >= {q} * n THEN {low} + ({b} - {low}) * ({q} * n - {below}) / (c{i} - {below})")
    return f"CASE {' '.join(whens)} ELSE {_BOUNDS[-1]} END"


@query("latency_quantiles", f"""
 SELECT {ts("w")} AS window_start, endpoint, {", ".join(f"{fx(_quantile_sql(q))} AS p{round(q * 100)}" for q in (0.5, 0.95, 0.99))}
 FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS w, event_type AS endpoint, count(*) AS n,
   {", ".join(f"count(*) FILTER (WHERE value / 100 <= {b}) AS c{i}" for i, b in enumerate(_BOUNDS))} FROM events GROUP BY 1, 2)""")
def latency_quantiles(desk: Desk):
    return monitoring.latency_quantiles(desk.request_log(), every="1 day")


@query("latency_quantiles_5min", f"""
 SELECT {ts("w")} AS window_start, endpoint, {", ".join(f"{fx(_quantile_sql(q))} AS p{round(q * 100)}" for q in (0.5, 0.95, 0.99))}
 FROM (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS w, event_type AS endpoint, count(*) AS n,
   {", ".join(f"count(*) FILTER (WHERE value / 100 <= {b}) AS c{i}" for i, b in enumerate(_BOUNDS))} FROM events GROUP BY 1, 2)""")
def latency_quantiles_5min(desk: Desk):
    return monitoring.latency_quantiles(desk.request_log())


@query("freshness", f"""
 SELECT source_name, {ts("max(ingested_at)")} AS newest,
  CAST(max(ingested_at) < TIMESTAMP '2024-01-31 23:00:00' - INTERVAL 1 HOUR AS BIGINT) AS stale FROM v_raw_articles GROUP BY 1""")
def freshness(desk: Desk):
    return monitoring.freshness(desk.raw_articles(), F.lit("2024-01-31 23:00:00").cast("timestamp_ntz"))


# -- exports ---------------------------------------------------------------------------------------
_SIZES = """SELECT 'articles' AS table_name, count(*) AS row_count FROM v_articles
 UNION ALL SELECT 'sentiment_scores', count(*) FROM v_scores UNION ALL SELECT 'sources', count(*) FROM v_sources"""


def _exported(desk: Desk) -> dict:
    return {"articles": desk.articles(), "sentiment_scores": desk.scores(), "sources": desk.sources()}


@query("export_tables", _SIZES)
def export_tables(desk: Desk):
    path = shared_dir(desk.spark, "export")
    tables.export_tables(_exported(desk), path)
    tables.export_tables(_exported(desk), path)  # a second export replaces the first
    return tables.table_sizes(desk.spark, path, list(_exported(desk)))


@query("snapshot_tables", _SIZES + " UNION ALL SELECT 'comments', count(*) FROM v_comments UNION ALL SELECT 'stock_prices', count(*) FROM v_prices")
def snapshot_tables(desk: Desk):
    every = {**_exported(desk), "comments": desk.comments(), "stock_prices": desk.prices()}
    path = tables.snapshot_tables(every, shared_dir(desk.spark, "backup"), "20240201000000")
    return tables.table_sizes(desk.spark, path, list(every))


# -- crawl calendar -----------------------------------------------------------------------------------
@query("month_sequence", f"""
 SELECT source, strftime(m, '%Y-%m-%d') AS month FROM (
  SELECT DISTINCT l_returnflag AS source, date_trunc('month', unnest(range(first, last + INTERVAL 1 DAY, INTERVAL 1 MONTH))) AS m
  FROM (SELECT l_returnflag, date_trunc('month', min(l_shipdate)) AS first, date_trunc('month', max(l_shipdate)) AS last
        FROM lineitem GROUP BY 1))""")
def month_sequence(desk: Desk):
    spans = desk.table("lineitem").groupBy(c("l_returnflag").alias("source")).agg(
        F.to_date(F.min("l_shipdate")).alias("first"), F.to_date(F.max("l_shipdate")).alias("last"))
    return feeds.month_sequence(spans, "first", "last").select("source", "month")


@query("rolling_months", f"""
 SELECT {day("d")} AS day, strftime(d, '%Y-%m') || CASE WHEN day(d) <= 3 THEN ',' || strftime(d - INTERVAL 1 MONTH, '%Y-%m') ELSE '' END AS months
 FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)""")
def rolling_months(desk: Desk):
    days = desk.table("lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    return days.select("day", feeds.rolling_months(c("day")).alias("months"))


@query("crawl_slices", """
 SELECT host || '/' || y || '/' || lpad(CAST(m AS VARCHAR), 2, '0') || '/' AS prefix, CAST(NULL AS VARCHAR) AS "from", CAST(NULL AS VARCHAR) AS "to"
 FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders), range(1, 13) t(m), (VALUES ('www.cnn.com'), ('edition.cnn.com')) h(host)
 UNION ALL SELECT 'www.wsj.com/articles/' || l, y || '0101', y || '1231'
 FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders), (SELECT unnest(string_split('abcdefghijklmnopqrstuvwxyz0123456789', '')) AS l)""")
def crawl_slices(desk: Desk):
    years = desk.table("orders").select(F.year("o_orderdate").alias("year")).distinct()
    return feeds.crawl_slices(years, "cnn").unionByName(feeds.crawl_slices(years, "wsj"))


def _fetches(desk: Desk):
    return desk.table("lineitem").select(F.trunc("l_shipdate", "month").alias("month"),
                                         ((c("l_quantity") == 50) & (c("l_tax") == 0) & (c("l_discount") == 0)).alias("error"))


_STATUS = """(SELECT date_trunc('month', l_shipdate) AS m, count(*) AS fetched,
   count(*) FILTER (WHERE l_quantity = 50 AND l_tax = 0 AND l_discount = 0) AS errors FROM lineitem GROUP BY 1)"""


@query("month_status", f"SELECT {day('m')} AS month, fetched, errors, CAST(errors = 0 AS BIGINT) AS done FROM {_STATUS}")
def month_status(desk: Desk):
    return feeds.month_status(_fetches(desk))


@query("pending_months", f"""
 SELECT {day("m")} AS month FROM (SELECT DISTINCT date_trunc('month', o_orderdate) AS m FROM orders)
 WHERE m NOT IN (SELECT m FROM {_STATUS} WHERE errors = 0)""")
def pending_months(desk: Desk):
    months = desk.table("orders").select(F.trunc("o_orderdate", "month").alias("month")).distinct()
    return feeds.pending_months(months, feeds.month_status(_fetches(desk)))


# -- streaming -----------------------------------------------------------------------------------------
class StreamDesk(Desk):
    """The same domain tables over streams of the given files."""

    def table(self, name: str):
        schema = self.spark.read.parquet(f"{self.folder}/{name}.parquet").schema
        return self.spark.readStream.schema(schema).parquet(f"{self.folder}/[{name[0]}]{name[1:]}.parquet")  # a pattern may name a file or a folder of files


def _folders(desk: Desk, *names: str) -> list[str]:
    root = shared_dir(desk.spark, "stream")
    return [f"{root}/{n}" for n in names]


@query("stream_staging", f"SELECT {_STG} FROM v_stg_articles")
def stream_staging(desk: Desk):
    log, checkpoint = _folders(desk, "staging", "checkpoint")
    jobs.publish_staging(StreamDesk(desk.spark, desk.folder).raw_articles(), log, checkpoint)
    return staged(jobs.current_staging(desk.spark, log))


def staged(log):
    return log.select(
        "article_id", "url", "source_name", "title", pii.pii_hash(c("author_raw")).alias("author_hash"), "content", "push_count",
        "published_at", F.coalesce("scraped_raw", "ingested_at").alias("scraped_at"), c("ingested_at").alias("ingest_time"))


@query("stream_ingest_hourly", _HOURLY)
def stream_ingest_hourly(desk: Desk):
    counts, checkpoint = _folders(desk, "hourly", "checkpoint")
    jobs.hourly_ingest(StreamDesk(desk.spark, desk.folder).raw_articles(), counts, checkpoint)
    return jobs.current_hourly(desk.spark, counts)


@query("stream_dedup", "SELECT DISTINCT url, source_name FROM v_extracted")
def stream_dedup(desk: Desk):
    urls, checkpoint = _folders(desk, "urls", "checkpoint")
    jobs.first_deliveries(StreamDesk(desk.spark, desk.folder).raw_articles(), urls, checkpoint)
    return jobs.first_seen(desk.spark, urls).read().select("url", "source_name")


@query("stream_fact", f"SELECT {_FACT} FROM v_fact")
def stream_fact(desk: Desk):
    articles, facts, checkpoint = _folders(desk, "articles", "fact", "checkpoint")
    jobs.refresh_fact(StreamDesk(desk.spark, desk.folder).articles(), desk.scores(), desk.sources(), articles, facts, checkpoint)
    return desk.spark.read.parquet(facts)


# -- SQL functions -----------------------------------------------------------------------------------------
@query("sql_functions", """
 SELECT e.event_id, substr(sha256('change-me-in-production:user' || user_id), 1, 16) AS author_hash, s.market_code,
  CAST(CASE WHEN value >= 100 THEN 100 ELSE floor(value) END AS BIGINT) AS push_count,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS published_at, 'https://x.com/a/' || event_id || '?k=user' || user_id AS url
 FROM events e JOIN v_sources s ON s.kind = e.event_type""")
def sql_functions(desk: Desk):
    """The registered SQL functions give the same values as the column rules."""
    from moodtide.functions.register import register_functions
    register_functions(desk.spark)
    names = {k: dict(SOURCE_ROWS)[i] for k, i in SOURCE_IDS.items()}
    rows = desk.table("events").select(
        "event_id", F.concat(F.lit("user"), c("user_id").cast("string")).alias("author"),
        config.lookup(c("event_type"), names).alias("source"), desk.published_text().alias("written"),
        F.when(c("value") >= 100, "爆").otherwise(F.floor("value").cast("string")).alias("badge"))
    return rows.select("event_id", F.expr("pii_hash(author)").alias("author_hash"),
                       F.expr("market_for_source(source)").alias("market_code"), F.expr("push_decode(badge)").alias("push_count"),
                       F.expr("parse_date_by_source(written, source)").alias("published_at"),
                       F.expr("canonical_url(concat('HTTP://X.com:80/a/', event_id, '/?src=1&k=', author))").alias("url"))


