"""Staging, warehouse and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import day, dec, fx, query, ts
from moodtide.functions import pii
from moodtide.operators import dedup, merge, prices
from moodtide.plans import staging, warehouse
from moodtide.session import shared_dir
from moodtide.sources.domain import Desk

c = F.col


# -- staging ---------------------------------------------------------------------------------
@query("stg_v1_articles", f"""
 SELECT article_id, CAST(source_id AS BIGINT) AS source_id, url, title, author AS author_hash, content,
  CAST(push_count AS BIGINT) AS push_count, {ts("published_at")} AS published_at, {ts("scraped_at")} AS scraped_at
 FROM v_articles""")
def stg_v1_articles(desk: Desk):
    return staging.typed_articles(desk.articles())


@query("stg_v1_scores", f"SELECT article_id, {fx('score')} AS score, {ts('calculated_at')} AS calculated_at FROM v_scores")
def stg_v1_scores(desk: Desk):
    return staging.typed_scores(desk.scores())


@query("stg_v1_sources", """
 SELECT CAST(s.source_id AS BIGINT) AS source_id, s.source_name, s.url AS source_url, count(*) AS articles
 FROM v_sources s JOIN v_articles a ON a.source_id = s.source_id GROUP BY 1, 2, 3""")
def stg_v1_sources(desk: Desk):
    used = desk.articles().groupBy("source_id").agg(F.count(F.lit(1)).alias("articles"))
    return staging.typed_sources(desk.sources()).join(used, "source_id")


_STG = f"""article_id, url, source_name, title, author_hash, content, CAST(push_count AS BIGINT) AS push_count,
  {ts("published_at")} AS published_at, {ts("scraped_at")} AS scraped_at, {ts("ingest_time")} AS ingest_time"""


@query("stg_articles_v2", f"SELECT {_STG}, 'raw_articles' AS source_system FROM v_stg_articles")
def stg_articles_v2(desk: Desk):
    return staging.stage_articles(desk.raw_articles())


@query("stg_articles_odd_ids", f"SELECT {_STG}, 'raw_articles' AS source_system FROM v_odd_stg_articles")
def stg_articles_odd_ids(desk: Desk):
    """Deliveries with null and negative ids, ids that two URLs share, and rows that were landed twice: still one row a URL, and its own."""
    raw, i = desk.raw_articles(), c("raw_id")
    twice = raw.unionByName(raw.where((i % 37).isin(0, 1)))
    odd = F.when(i % 23 == 0, F.lit(None)).when(i % 29 == 0, -i).when(i % 31 == 0, i - 2).otherwise(i)
    return staging.stage_articles(twice.withColumn("raw_id", odd))


@query("stg_sentiment_scores_v2", f"""
 SELECT score_id, article_id_raw, {fx("score")} AS score, {ts("calculated_at")} AS calculated_at, {ts("ingest_time")} AS ingest_time,
  'raw_sentiment_scores' AS source_system FROM v_stg_scores""")
def stg_sentiment_scores_v2(desk: Desk):
    return staging.stage_scores(desk.raw_scores())


@query("stg_sources_v2", f"""
 SELECT source_id, source_name, source_url, {ts("ingest_time")} AS ingest_time, 'raw_sources' AS source_system FROM v_stg_sources""")
def stg_sources_v2(desk: Desk):
    return staging.stage_sources(desk.raw_sources())


def _with_sentiment(desk: Desk, columns: list[str] | None = None):
    return staging.articles_with_sentiment(staging.stage_articles(desk.raw_articles(), columns), staging.stage_scores(desk.raw_scores()))


@query("int_articles_with_sentiment", f"""
 SELECT {_STG}, {fx("sentiment_score")} AS sentiment_score, {ts("sentiment_score_calculated_at")} AS sentiment_score_calculated_at
 FROM v_int_articles""")
def int_articles_with_sentiment(desk: Desk):
    return _with_sentiment(desk)


@query("int_market_summary", f"""
 SELECT a.article_id, a.url, a.source_name, s.source_id, s.source_url, v.market_code, a.title, a.author_hash,
  CAST(a.push_count AS BIGINT) AS push_count, {ts("a.published_at")} AS published_at, {ts("a.scraped_at")} AS scraped_at,
  {fx("a.sentiment_score")} AS sentiment_score, {ts("a.sentiment_score_calculated_at")} AS sentiment_score_calculated_at,
  {ts("a.ingest_time")} AS ingest_time
 FROM v_int_articles a LEFT JOIN v_stg_sources s ON s.source_name = a.source_name
 LEFT JOIN v_sources v ON v.source_name = a.source_name""")
def int_market_summary(desk: Desk):
    return staging.market_articles(_with_sentiment(desk), staging.stage_sources(desk.raw_sources()))


# -- dimensions: with what the data says about each row -----------------------------------------
@query("dim_market", """
 SELECT market_id, d.market_code, market_name, currency, timezone, count(*) AS articles
 FROM (VALUES (CAST(1 AS BIGINT), 'TW', '台灣股市', 'TWD', 'Asia/Taipei'), (2, 'US', '美國股市', 'USD', 'America/New_York'))
   d(market_id, market_code, market_name, currency, timezone)
 JOIN v_articles a ON a.market_code = d.market_code GROUP BY ALL""")
def dim_market(desk: Desk):
    per_source = desk.articles().groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
    per_market = per_source.join(warehouse.dim_source(desk.sources()), "source_id").groupBy("market_id").agg(
        F.sum("n").alias("articles"))
    return warehouse.dim_market(desk.spark).join(per_market, "market_id")


@query("dim_source", """
 SELECT CAST(s.source_id AS BIGINT) AS source_id, s.source_name, s.url,
  CAST(CASE s.market_code WHEN 'TW' THEN 1 ELSE 2 END AS BIGINT) AS market_id, s.tracked_stock, count(*) AS articles
 FROM v_sources s JOIN v_articles a ON a.source_id = s.source_id GROUP BY ALL""")
def dim_source(desk: Desk):
    used = desk.articles().groupBy("source_id").agg(F.count(F.lit(1)).alias("articles"))
    return warehouse.dim_source(desk.sources()).join(used, "source_id")


@query("dim_stock", """
 SELECT stock_id, d.symbol, name, count(*) AS trading_days
 FROM (VALUES (CAST(1 AS BIGINT), '0050', '元大台灣50'), (2, 'VOO', 'Vanguard S&P 500 ETF')) d(stock_id, symbol, name)
 JOIN v_prices p ON p.symbol = d.symbol GROUP BY ALL""")
def dim_stock(desk: Desk):
    traded = desk.prices().groupBy("symbol").agg(F.count(F.lit(1)).alias("trading_days"))
    return warehouse.dim_stock(desk.spark).join(traded, "symbol")


@query("dim_source_unknown", """
 SELECT source AS source_name, CAST(1 AS BIGINT) AS market_id, CAST(NULL AS VARCHAR) AS tracked_stock, count(*) AS documents
 FROM documents GROUP BY 1""")
def dim_source_unknown(desk: Desk):
    """Sources nobody configured count to the default market and track no instrument."""
    names = desk.table("documents").groupBy(c("source").alias("source_name")).agg(F.count(F.lit(1)).alias("documents"))
    dims = warehouse.dim_source(names.select(F.lit(0).alias("source_id"), "source_name", F.lit("").alias("url")))
    return dims.join(names, "source_name").select("source_name", "market_id", "tracked_stock", "documents")


# -- facts and marts ---------------------------------------------------------------------------
def fact(desk: Desk):
    dims = warehouse.dim_source(desk.sources())
    return warehouse.fact_sentiment(desk.articles(), desk.scores(), desk.sources(), dims)


_FACT = f"""{day("fact_date")} AS fact_date, CAST(source_id AS BIGINT) AS source_id, stock_symbol, source_name, article_count,
  scored_articles, CAST(avg_sentiment AS DOUBLE) AS avg_sentiment, CAST(avg_push_count AS DOUBLE) AS avg_push_count"""


@query("fact_sentiment", f"SELECT {_FACT} FROM v_fact")
def fact_sentiment(desk: Desk):
    return fact(desk)


@query("mart_daily_summary", f"""
 SELECT {day("summary_date")} AS summary_date, source_name, total_articles, scored_articles,
  CAST(avg_sentiment AS DOUBLE) AS avg_sentiment, CAST(avg_push_count AS DOUBLE) AS avg_push_count FROM v_mart_daily""")
def mart_daily_summary(desk: Desk):
    return warehouse.mart_daily_summary(fact(desk))


_MARKET_SQL = f"""
 SELECT {day("f.fact_date")} AS fact_date, s.market_code, count(DISTINCT s.source_id) AS source_count,
  CAST(sum(article_count) AS BIGINT) AS total_articles, CAST(sum(scored_articles) AS BIGINT) AS scored_articles,
  CAST({dec("CAST(sum(avg_sentiment * scored_articles) AS DOUBLE) / nullif(sum(scored_articles), 0)", 5, 4)} AS DOUBLE) AS avg_sentiment,
  CAST({dec("CAST(sum(avg_push_count * article_count) AS DOUBLE) / nullif(sum(article_count), 0)", 8, 2)} AS DOUBLE) AS avg_push_count
 FROM v_fact f JOIN v_sources s ON s.source_id = f.source_id GROUP BY 1, 2"""


def market_mart(desk: Desk):
    return warehouse.mart_market_summary(fact(desk), warehouse.dim_source(desk.sources()), warehouse.dim_market(desk.spark))


@query("mart_market_summary", _MARKET_SQL)
def mart_market_summary(desk: Desk):
    return market_mart(desk)


_MOOD = f"""{day("fact_date")} AS fact_date, CAST(source_id AS BIGINT) AS source_id, source_name, article_count, pos_count,
  neg_count, neu_count, {fx("avg_score")} AS avg_score"""
_RATIOS = f"{fx('pos_count / nullif(article_count, 0)')} AS pos_ratio, {fx('neg_count / nullif(article_count, 0)')} AS neg_ratio"


def mood_v1(desk: Desk):
    return warehouse.fact_mood(desk.articles(), desk.scores(), desk.sources())


def mood_v2(desk: Desk):
    return warehouse.fact_mood_v2(_with_sentiment(desk, ["url", "source_name", "scraped_at"]), staging.stage_sources(desk.raw_sources()))


@query("fact_sentiment_dbt", f"SELECT {_MOOD} FROM v_fact_mood")
def fact_sentiment_dbt(desk: Desk):
    return mood_v1(desk)


@query("fact_sentiment_v2", f"SELECT {_MOOD}, pipeline_version FROM v_fact_mood_v2")
def fact_sentiment_v2(desk: Desk):
    return mood_v2(desk)


@query("mart_daily_ratios", f"SELECT {_MOOD}, {_RATIOS} FROM v_fact_mood")
def mart_daily_ratios(desk: Desk):
    return warehouse.mood_ratios(mood_v1(desk))


@query("mart_daily_ratios_v2", f"SELECT {_MOOD}, {_RATIOS}, pipeline_version FROM v_fact_mood_v2")
def mart_daily_ratios_v2(desk: Desk):
    return warehouse.mood_ratios(mood_v2(desk))


@query("mart_daily_ratios_flagged", f"SELECT * EXCLUDE (source_id) FROM (SELECT {_MOOD}, {_RATIOS} FROM v_fact_mood_v2)")
def mart_daily_ratios_flagged(desk: Desk):
    return warehouse.public_ratios(mood_v1(desk), mood_v2(desk), use_v2=True)


@query("parity_v1_v2", """
 SELECT CASE WHEN b.fact_date IS NULL THEN 'only_v1' WHEN a.fact_date IS NULL THEN 'only_v2'
   WHEN a.article_count <> b.article_count THEN 'differs_article_count' WHEN a.pos_count <> b.pos_count THEN 'differs_pos_count'
   WHEN a.neg_count <> b.neg_count THEN 'differs_neg_count' ELSE 'equal' END AS state, count(*) AS n
 FROM v_fact_mood a FULL JOIN v_fact_mood_v2 b ON a.fact_date = b.fact_date AND a.source_name = b.source_name GROUP BY 1""")
def parity_v1_v2(desk: Desk):
    return warehouse.parity(mood_v1(desk), mood_v2(desk), ["fact_date", "source_name"],
                            ["article_count", "pos_count", "neg_count"])


@query("clustered_fact", f"SELECT {_FACT} FROM v_fact")
def clustered_fact(desk: Desk):
    from moodtide.sources.tables import write_clustered
    path = shared_dir(desk.spark, "clustered-fact")
    write_clustered(fact(desk), path, "fact_date", files=4)
    return desk.spark.read.parquet(path)


# -- merges ---------------------------------------------------------------------------------------
_LATE = "2024-01-20"


def _announced(desk: Desk):
    """Sources as the crawler announces them, in order of appearance."""
    raw = desk.raw_sources()
    return raw.select(F.get_json_object("raw_payload", "$.url").alias("url"),
                      F.trim(F.lower("source_name")).alias("source_name"), c("raw_id").alias("source_id"))


@query("merge_insert_only", """
 SELECT url, source_name, source_id FROM (
  SELECT url, CASE WHEN source_id IN (1, 3) THEN upper(source_name) ELSE source_name END AS source_name,
   CASE WHEN source_id IN (1, 3) THEN CAST(source_id AS BIGINT) ELSE (SELECT min(raw_id) FROM v_raw_sources r WHERE r.url = s.url) END
     AS source_id FROM v_sources s)""")
def merge_insert_only(desk: Desk):
    """Two sources are known already and keep name and id; the others are inserted once, at their first announcement."""
    known = desk.sources().where("has_push_count").select(
        "url", F.upper("source_name").alias("source_name"), c("source_id").cast("bigint").alias("source_id"))
    return merge.insert_absent(known, _announced(desk), ["url"], ["source_id"])


def _incoming(desk: Desk):
    """Raw deliveries as article rows; a URL may come several times."""
    return staging.extract_articles(desk.raw_articles()).select(
        "url", c("raw_id").alias("article_id"), "source_name", "title", "push_count", "published_at")


@query("merge_articles", f"""
 SELECT url, article_id, source_name, title, CAST(push_count AS BIGINT) AS push_count, {ts("published_at")} AS published_at FROM (
  SELECT a.url, a.article_id, a.source_name, a.title, a.push_count, a.published_at FROM v_articles a
   WHERE a.published_at < TIMESTAMP '{_LATE}'
  UNION ALL SELECT url, raw_id, source_name, title, push_count, published_at FROM (
   SELECT *, row_number() OVER (PARTITION BY url ORDER BY raw_id) AS rn FROM v_extracted)
  WHERE rn = 1 AND url NOT IN (SELECT url FROM v_articles WHERE published_at < TIMESTAMP '{_LATE}'))""")
def merge_articles(desk: Desk):
    stored = desk.articles().where(c("published_at") < F.lit(_LATE).cast("timestamp_ntz")).join(
        desk.sources().select("source_id", "source_name"), "source_id").select(
        "url", "article_id", "source_name", "title", "push_count", "published_at")
    return merge.insert_absent(stored, _incoming(desk), ["url"], ["article_id"])


@query("insert_comments", f"""
 SELECT comment_id, c.article_id, author, push_tag, message FROM v_comments c
 WHERE article_id IN (SELECT article_id FROM v_articles WHERE published_at >= TIMESTAMP '2024-01-01 06:00:00')""")
def insert_comments(desk: Desk):
    """Comments are stored only with an article that was new in this run."""
    stored = desk.articles().where(c("published_at") < F.lit("2024-01-01 06:00:00").cast("timestamp_ntz"))
    new = dedup.absent_from(desk.articles(), stored, ["url"])
    return desk.comments().join(new.select("article_id"), "article_id", "left_semi")


@query("merge_fact", f"SELECT {_FACT} FROM v_fact")
def merge_fact(desk: Desk):
    """An early load with fewer scores is overwritten by a later one, day and source at a time."""
    dims, early = warehouse.dim_source(desk.sources()), desk.scores().where("score > 0")
    target = warehouse.fact_sentiment(desk.articles(), early, desk.sources(), dims)
    return merge.upsert(target, fact(desk), ["fact_date", "source_id"], [F.lit(1)])


@query("merge_scores", f"""
 SELECT a.article_id, {fx("coalesce(n.score, o.score)")} AS score, {ts("coalesce(o.calculated_at, n.calculated_at)")} AS calculated_at
 FROM (SELECT article_id FROM v_scores) a
 LEFT JOIN (SELECT article_id, score, calculated_at FROM v_scores WHERE score <= 0) o ON o.article_id = a.article_id
 LEFT JOIN (SELECT article_id, round(score / 2, 4) AS score, calculated_at + INTERVAL 3 DAY AS calculated_at
            FROM v_scores WHERE score >= -0.5) n ON n.article_id = a.article_id""")
def merge_scores(desk: Desk):
    """New scores overwrite, the first calculation time stays."""
    stored = desk.scores().where("score <= 0")
    new = desk.scores().where("score >= -0.5").select(
        "article_id", F.round(c("score") / 2, 4).alias("score"),
        (c("calculated_at") + F.expr("INTERVAL 3 DAYS")).alias("calculated_at"))
    return merge.upsert(stored, new, ["article_id"], ["calculated_at"], keep=["calculated_at"])


@query("merge_labels", f"""
 SELECT l.article_id, CASE WHEN d.lang = 'en' THEN 'neutral' ELSE l.label END AS label,
  {ts("CASE WHEN d.lang = 'en' THEN l.labeled_at + INTERVAL 1 DAY ELSE l.labeled_at END")} AS labeled_at
 FROM v_labels l JOIN documents d ON d.doc_id = l.article_id""")
def merge_labels(desk: Desk):
    """A second opinion replaces label and time."""
    labels = desk.article_labels()
    english = desk.texts().where("lang = 'en'").select("article_id")
    second = labels.join(english, "article_id", "left_semi").select(
        "article_id", F.lit("neutral").alias("label"), (c("labeled_at") + F.expr("INTERVAL 1 DAY")).alias("labeled_at"))
    return merge.upsert(labels, second, ["article_id"], ["labeled_at"])


@query("merge_prices", f"""
 SELECT symbol, {day("trade_date")} AS trade_date, CAST(CASE WHEN trade_date >= DATE '2000-01-01' THEN close + 1 ELSE close END AS DOUBLE)
  AS close, CAST(CASE WHEN trade_date >= DATE '2000-01-01' THEN NULL ELSE change END AS DOUBLE) AS change FROM v_price_changes""")
def merge_prices(desk: Desk):
    stored = prices.with_changes(desk.prices())
    revised = stored.where("trade_date >= DATE'2000-01-01'").select(
        "symbol", "trade_date", (c("close") + 1).cast("decimal(10,2)").alias("close"),
        F.lit(None).cast("decimal(10,2)").alias("change"))
    return merge.upsert(stored, revised, ["symbol", "trade_date"], [F.lit(1)])


@query("mart_refresh", _MARKET_SQL)
def mart_refresh(desk: Desk):
    """The market mart written as a new version and read back."""
    path = merge.write_version(market_mart(desk), shared_dir(desk.spark, "mart"), "1")
    return desk.spark.read.parquet(path)


@query("parse_and_hash_v1_v2", """
 SELECT count(*) AS urls, count(*) FILTER (WHERE substr(sha256('change-me-in-production:' || a.author), 1, 16) = s.author_hash)
   AS same_author, count(*) FILTER (WHERE date_trunc('second', a.published_at) = s.published_at) AS same_time
 FROM v_articles a JOIN v_stg_articles s ON s.url = a.url""")
def parse_and_hash_v1_v2(desk: Desk):
    """Both branches have to agree on author and time of every URL."""
    v1 = desk.articles().select("url", pii.pii_hash(c("author")).alias("hash"),
                                F.date_trunc("second", "published_at").cast("timestamp_ntz").alias("at"))
    both = v1.join(staging.stage_articles(desk.raw_articles(), ["url", "author_hash", "published_at"]), "url")
    return both.agg(F.count(F.lit(1)).alias("urls"), F.count_if(c("hash") == c("author_hash")).alias("same_author"),
                    F.count_if(c("at") == c("published_at")).alias("same_time"))


