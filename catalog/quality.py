"""Data-quality checks, repair candidates and the row contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import fx, query
from moodtide import config
from moodtide.operators import dedup, prices, quality
from moodtide.plans import staging, warehouse
from moodtide.session import shared_dir
from moodtide.sources.domain import Desk
from moodtide.sources.tables import export_tables

c = F.col


# -- row contract ----------------------------------------------------------------------------
def incoming(desk: Desk):
    """Articles as scraped, some of them broken: blank titles, wrong addresses, too many votes, future dates."""
    v = c("value")
    return desk.table("events").select(
        "event_id", F.when(v < 2, "  ").when(v < 3, F.lit(None)).otherwise(F.concat_ws(" ", "event_type", "user_id")).alias("title"),
        F.when(v.between(50, 52), F.lit(None)).otherwise(c("props")).alias("content"),
        F.concat(F.when(v.between(60, 62), "ftp://").otherwise("https://"), F.lit("x/"), c("event_id").cast("string")).alias("url"),
        F.when(c("event_type") != "click", (F.floor("value") - 50).cast("int")).alias("push_count"),
        F.when(v.between(70, 71), F.lit(None)).otherwise(c("ts")).alias("published_at"))


_REASONS = """array_to_string(list_filter([
   CASE WHEN value < 3 THEN 'title' END, CASE WHEN value BETWEEN 50 AND 52 THEN 'content' END, CASE WHEN value BETWEEN 60 AND 62 THEN 'url' END,
   CASE WHEN event_type <> 'click' AND floor(value) - 50 NOT BETWEEN -100 AND 100 THEN 'push_count' END,
   CASE WHEN value BETWEEN 70 AND 71 OR ts > TIMESTAMP '2024-01-29 00:00:00' THEN 'published_at' END], lambda x: x IS NOT NULL), ',')"""


@query("validate_articles", f"""
 SELECT event_id, reasons, CAST(reasons = '' AS BIGINT) AS valid FROM (SELECT event_id, {_REASONS} AS reasons FROM events)""")
def validate_articles(desk: Desk):
    checked = quality.validate_articles(incoming(desk), F.lit("2024-01-29 00:00:00").cast("timestamp_ntz"))
    return checked.select("event_id", "reasons", "valid")


@query("rejected_counts", f"""
 SELECT reason, count(*) AS n FROM (SELECT unnest(string_split({_REASONS}, ',')) AS reason FROM events) WHERE reason <> '' GROUP BY 1""")
def rejected_counts(desk: Desk):
    checked = quality.validate_articles(incoming(desk), F.lit("2024-01-29 00:00:00").cast("timestamp_ntz"))
    return checked.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# -- table checks -------------------------------------------------------------------------------
def damaged(desk: Desk):
    """Articles with fields that got lost."""
    score = desk.table("events").select(c("event_id").alias("article_id"), "value")
    lost = lambda name, low, high: F.when(~c("value").between(low, high), c(name)).alias(name)
    return desk.articles().join(score, "article_id").select(
        "article_id", "source_id", "url", lost("title", 20, 20.5), lost("content", 20.3, 21), lost("published_at", 30, 30.4),
        lost("push_count", 40, 41))


_DAMAGED = """(SELECT article_id, source_id, source_name, url, CASE WHEN value NOT BETWEEN 20 AND 20.5 THEN title END AS title,
   CASE WHEN value NOT BETWEEN 20.3 AND 21 THEN content END AS content, CASE WHEN value NOT BETWEEN 30 AND 30.4 THEN published_at END AS published_at,
   CASE WHEN value NOT BETWEEN 40 AND 41 THEN push_count END AS push_count FROM v_articles)"""


def _row(seq: int, check: str, scope: str, bad: str, n: str, source: str, severity: str = "error") -> str:
    return f"SELECT CAST({seq} AS BIGINT) AS seq, '{check}' AS \"check\", '{scope}' AS scope, '{severity}' AS severity, CAST({bad} AS BIGINT) AS violations, CAST({n} AS BIGINT) AS elements FROM {source}"


def _nulls(seq: int, table: str, column: str, source: str, severity: str = "error") -> str:
    return _row(seq, "not_null", f"{table}.{column}", f"count(*) FILTER (WHERE {column} IS NULL)", "count(*)", source, severity)


def _empty(seq: int, table: str, source: str) -> str:
    return _row(seq, "not_empty", table, "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", "count(*)", source)


_TW, _US = ("(SELECT * FROM v_price_changes WHERE symbol = '0050')", "(SELECT * FROM v_price_changes WHERE symbol = 'VOO')")
_CHECKS = " UNION ALL ".join([
    _empty(1, "sources", "v_sources"), _empty(2, "articles", "v_articles"),
    _row(3, "unique", "articles.url", "count(*)", "count(*)", "(SELECT url FROM v_articles GROUP BY 1 HAVING count(*) > 1)"),
    *[_nulls(10 + i, "articles", f, _DAMAGED) for i, f in enumerate(["title", "content", "url", "published_at"])],
    *[_row(20 + i, "push_count_not_null", s, f"count(*) FILTER (WHERE source_name = '{s}' AND push_count IS NULL)",
           f"count(*) FILTER (WHERE source_name = '{s}')", _DAMAGED) for i, s in enumerate(["ptt", "reddit"])],
    _row(30, "orphans", "comments", "count(*)", "count(*)", "(SELECT * FROM v_comments WHERE article_id NOT IN (SELECT article_id FROM v_articles))"),
    *[_nulls(31 + i, "comments", f, "v_comments") for i, f in enumerate(["author", "push_tag", "message"])],
    _row(40, "orphans", "sentiment_scores", "count(*)", "count(*)", "(SELECT * FROM v_scores WHERE article_id NOT IN (SELECT article_id FROM v_articles))"),
    _nulls(41, "sentiment_scores", "score", "v_scores"),
    _empty(50, "stock_prices", _TW), _nulls(51, "stock_prices", "trade_date", _TW), _nulls(52, "stock_prices", "close", _TW),
    _empty(60, "us_stock_prices", _US), _nulls(61, "us_stock_prices", "trade_date", _US), _nulls(62, "us_stock_prices", "close", _US),
    _nulls(63, "us_stock_prices", "change", _US, "warn")])
# A failed check has violations; all of these rules have to hold for every row.
_PASSED = "SELECT *, CAST(violations = 0 AS BIGINT) AS passed FROM"


def two_prices(desk: Desk):
    changes = prices.with_changes(desk.prices())
    return changes.where("symbol = '0050'"), changes.where("symbol = 'VOO'")


@query("qa_checks", f"{_PASSED} ({_CHECKS})")
def qa_checks(desk: Desk):
    tw, us = two_prices(desk)
    return quality.table_checks(damaged(desk), desk.comments(), desk.scores(), desk.sources(), tw, us)


@query("orphan_rows", """
 SELECT 'comments' AS table_name, comment_id AS row_id, article_id FROM v_comments WHERE article_id NOT IN (SELECT article_id FROM v_articles)
 UNION ALL SELECT 'sentiment_scores', article_id, article_id FROM v_scores
  WHERE article_id NOT IN (SELECT article_id FROM v_articles WHERE source_id <> 4)""")
def orphan_rows(desk: Desk):
    """Comments without article, and scores left behind when the articles of one source are removed."""
    kept = desk.articles().where("source_id <> 4")
    comments = dedup.absent_from(desk.comments(), desk.articles(), ["article_id"]).select(
        F.lit("comments").alias("table_name"), c("comment_id").alias("row_id"), "article_id")
    scores = dedup.absent_from(desk.scores(), kept, ["article_id"]).select(
        F.lit("sentiment_scores").alias("table_name"), c("article_id").alias("row_id"), "article_id")
    return comments.unionByName(scores)


_PATTERNS = {"ptt": r"/bbs/[Ss]tock/.*", "cnyes": r"news\.cnyes\.com/news/id/\d+", "reddit": r"reddit\.com/r/\w+/comments/",
             "cnn": r"(cnn\.com/|news\.google\.com/rss/articles/)", "wsj": r"(wsj\.com/|news\.google\.com/rss/articles/)"}


def real_urls(desk: Desk):
    """Addresses in each source's own form, except for some."""
    forms = {"1": "https://www.ptt.cc/bbs/Stock/M.", "2": "https://news.cnyes.com/news/id/", "3": "https://www.reddit.com/r/stocks/comments/",
             "4": "https://edition.cnn.com/2024/", "5": "https://www.wsj.com/articles/"}
    value = desk.table("events").select(c("event_id").alias("article_id"), "value")
    form = config.lookup(c("source_id").cast("string"), forms)
    return desk.articles().join(value, "article_id").withColumn("url", F.when(
        c("value") > 150, F.concat(F.lit("https://elsewhere.example/"), c("article_id").cast("string"))).otherwise(
        F.concat(form, c("article_id").cast("string"))))


_FORMS = "CASE source_id WHEN 1 THEN 'https://www.ptt.cc/bbs/Stock/M.' WHEN 2 THEN 'https://news.cnyes.com/news/id/' WHEN 3 THEN 'https://www.reddit.com/r/stocks/comments/' WHEN 4 THEN 'https://edition.cnn.com/2024/' ELSE 'https://www.wsj.com/articles/' END"
_REAL = f"(SELECT * REPLACE (CASE WHEN value > 150 THEN 'https://elsewhere.example/' ELSE {_FORMS} END || article_id AS url) FROM v_articles)"
_EXPECT = " UNION ALL ".join([
    _nulls(1, "all", "title", _REAL), _nulls(2, "all", "url", _REAL),
    *[_row(10 + 10 * i, "url_pattern", s, f"count(*) FILTER (WHERE source_name = '{s}' AND NOT regexp_matches(url, '{p}'))",
           f"count(*) FILTER (WHERE source_name = '{s}')", _REAL) for i, (s, p) in enumerate(_PATTERNS.items())],
    *[_row(10 + 10 * i + 1, "push_not_null", s, f"count(*) FILTER (WHERE source_name = '{s}' AND push_count IS NULL)",
           f"count(*) FILTER (WHERE source_name = '{s}')", _REAL) for i, s in ((0, "ptt"), (2, "reddit"))],
    *[_row(10 + 10 * i + 2, "push_range", s, f"count(*) FILTER (WHERE source_name = '{s}' AND push_count NOT BETWEEN -100 AND 100)",
           f"count(*) FILTER (WHERE source_name = '{s}' AND push_count IS NOT NULL)", _REAL) for i, s in ((0, "ptt"), (2, "reddit"))],
    _nulls(100, "us_stock_prices", "trade_date", _US), _nulls(101, "us_stock_prices", "close", _US),
    _row(102, "close_range", "us_stock_prices", "count(*) FILTER (WHERE close NOT BETWEEN 1 AND 10000)", "count(close)", _US),
    _row(103, "change_range", "us_stock_prices", "count(*) FILTER (WHERE change NOT BETWEEN -100 AND 100)", "count(change)", _US)])


@query("expectations", f"""
 SELECT *, {fx("violations * 100.0 / elements")} AS percent,
  CAST(CASE WHEN seq = 103 THEN (elements - violations) / elements >= 0.99 ELSE violations = 0 END AS BIGINT) AS passed
 FROM ({_EXPECT}) WHERE elements > 0""")
def expectations(desk: Desk):
    return quality.expectations(real_urls(desk), desk.sources(), two_prices(desk)[1])


@query("diagnose", f"""
 SELECT article_id, url, source_name, array_to_string(list_filter([CASE WHEN title IS NULL THEN 'title' END,
   CASE WHEN content IS NULL THEN 'content' END, CASE WHEN published_at IS NULL THEN 'published_at' END], lambda x: x IS NOT NULL), ',') AS bad_fields
 FROM {_DAMAGED} WHERE title IS NULL OR content IS NULL OR published_at IS NULL""")
def diagnose(desk: Desk):
    return quality.diagnose(damaged(desk), desk.sources())


# -- schema tests on raw, staging and marts ----------------------------------------------------------
def _unique(seq: int, table: str, column: str, source: str) -> str:
    return _row(seq, "unique", f"{table}.{column}", "count(*)", "count(*)",
                f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")


_NAMES = "('ptt','cnyes','reddit','cnn','wsj','marketwatch','wayback_cnn','wayback_wsj')"


def _holds(seq: int, check: str, scope: str, condition: str, source: str, severity: str = "error") -> str:
    return _row(seq, check, scope, f"count(*) FILTER (WHERE NOT ({condition}))", f"count({condition})", source, severity)


_SCHEMA = " UNION ALL ".join([
    *[_nulls(i, "raw_articles", f, "v_raw_articles") for i, f in enumerate(["raw_id", "source_name", "raw_payload", "ingested_at"], 1)],
    _unique(5, "raw_articles", "raw_id", "v_raw_articles"),
    *[_nulls(i, "stg_articles", f, "v_stg_articles") for i, f in enumerate(["article_id", "url", "source_name"], 10)],
    _holds(13, "accepted_values", "stg_articles.source_name", f"source_name IN {_NAMES}", "v_stg_articles"),
    _holds(14, "author_hash_length", "stg_articles", "length(author_hash) = 16", "v_stg_articles", "warn"),
    _unique(15, "stg_articles", "article_id", "v_stg_articles"), _unique(16, "stg_articles", "url", "v_stg_articles"),
    *[_nulls(i, "stg_scores", f, "v_stg_scores") for i, f in enumerate(["score_id", "article_id_raw", "score"], 20)],
    _unique(23, "stg_scores", "score_id", "v_stg_scores"),
    *[_nulls(i, "stg_sources", f, "v_stg_sources") for i, f in enumerate(["source_id", "source_name"], 30)],
    _unique(32, "stg_sources", "source_id", "v_stg_sources"), _unique(33, "stg_sources", "source_name", "v_stg_sources"),
    *[_nulls(i, "fact_v2", f, "v_fact_mood_v2") for i, f in enumerate(["fact_date", "source_id", "source_name", "article_count", "avg_score"], 40)],
    *[_nulls(i, "mart_daily_summary", f, "v_mart_daily") for i, f in enumerate(["summary_date", "source_name", "total_articles"], 50)],
    _holds(60, "accepted_values", "mart_market.market_code", "market_code IN ('US','TW')",
           "(SELECT DISTINCT fact_date, market_code FROM v_fact f JOIN v_sources s ON s.source_id = f.source_id)", "warn")])


@query("schema_tests", f"{_PASSED} ({_SCHEMA})")
def schema_tests(desk: Desk):
    from catalog.tables import fact, market_mart
    raw, q = desk.raw_articles(), quality
    # Build, then test what was built: each staging table is computed once, however many tests read it.
    path = shared_dir(desk.spark, "staging")
    built = {"articles": staging.stage_articles(raw), "scores": staging.stage_scores(desk.raw_scores()),
             "sources": staging.stage_sources(desk.raw_sources())}
    export_tables(built, path)
    stg, scores, sources = [desk.spark.read.parquet(f"{path}/{name}") for name in built]
    fact_v2 = warehouse.fact_mood_v2(staging.articles_with_sentiment(stg, scores), sources)
    nulls = lambda first, table, names: [q.not_null(i, table, n) for i, n in enumerate(names, first)]
    return q.union_all([
        q.run_rules(raw, nulls(1, "raw_articles", ["raw_id", "source_name", "raw_payload", "ingested_at"])),
        q.unique(5, raw, "raw_articles", "raw_id"),
        q.run_rules(stg, [
            *nulls(10, "stg_articles", ["article_id", "url", "source_name"]),
            q.satisfies(13, "accepted_values", "stg_articles.source_name", c("source_name").isin(list(config.ALL_SOURCES))),
            q.satisfies(14, "author_hash_length", "stg_articles", F.length("author_hash") == 16, q.WARN)]),
        q.unique(15, stg, "stg_articles", "article_id"), q.unique(16, stg, "stg_articles", "url"),
        q.run_rules(scores, nulls(20, "stg_scores", ["score_id", "article_id_raw", "score"])),
        q.unique(23, scores, "stg_scores", "score_id"),
        q.run_rules(sources, nulls(30, "stg_sources", ["source_id", "source_name"])),
        q.unique(32, sources, "stg_sources", "source_id"), q.unique(33, sources, "stg_sources", "source_name"),
        q.run_rules(fact_v2, nulls(40, "fact_v2", ["fact_date", "source_id", "source_name", "article_count", "avg_score"])),
        q.run_rules(warehouse.mart_daily_summary(fact(desk)), nulls(50, "mart_daily_summary", ["summary_date", "source_name", "total_articles"])),
        q.run_rules(market_mart(desk), [
            q.satisfies(60, "accepted_values", "mart_market.market_code", c("market_code").isin("US", "TW"), q.WARN)]),
    ])




@query("mart_checks", f"""{_PASSED} ({" UNION ALL ".join([
    _row(1, "groups_missing", "mart_daily_summary", "count(*)", "count(*)",
         "(SELECT fact_date, source_name FROM v_fact EXCEPT SELECT summary_date, source_name FROM v_mart_daily)"),
    _row(2, "groups_repeated", "mart_daily_summary", "count(*)", "count(*)",
         "(SELECT summary_date, source_name FROM v_mart_daily GROUP BY ALL HAVING count(*) > 1)"),
    _row(3, "accepted_values", "mart_market_summary.market_code", "count(*) FILTER (WHERE market_code NOT IN ('TW', 'US'))", "count(*)",
         "(SELECT DISTINCT fact_date, market_code FROM v_fact f JOIN v_sources s ON s.source_id = f.source_id)"),
    _row(4, "columns", "mart_daily_summary", "0", "6", "(SELECT 1)"), _row(5, "columns", "mart_market_summary", "0", "6", "(SELECT 1)")])})""")
def mart_checks(desk: Desk):
    from catalog.tables import fact, market_mart
    rows = fact(desk)
    return quality.mart_checks(rows, warehouse.mart_daily_summary(rows), market_mart(desk))
