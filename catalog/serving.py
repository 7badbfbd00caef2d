"""Read queries of the service and the dashboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import day, fx, query, ts
from catalog.tables import fact
from moodtide import config
from moodtide.operators import dedup, keywords, prices
from moodtide.plans import serving, warehouse
from moodtide.sources.domain import Desk

c = F.col
TODAY = "2024-01-30"


def today():
    return F.lit(TODAY).cast("date")


def mart(desk: Desk):
    return warehouse.mart_daily_summary(fact(desk))


def scored(desk: Desk):
    return serving.scored_articles(desk.articles(), desk.scores())


def board(desk: Desk):
    return serving.dashboard_articles(desk.articles(), desk.scores(), desk.sources())


# -- scans ------------------------------------------------------------------------------------
@query("articles_scored", f"""
 SELECT article_id AS "Article_id", title AS "Title", CAST(push_count AS BIGINT) AS "Push_count", author AS "Author", url AS "Url",
  {ts("published_at")} AS "Published_Time", {fx("score")} AS "Article_Sentiment_Score" FROM v_scored""")
def articles_scored(desk: Desk):
    return scored(desk)


_BOARD = f"""article_id AS "Article_id", title AS "Title", CAST(push_count AS BIGINT) AS "Push_count", {day("published_at")} AS "Date",
  url AS "Url", {fx("score")} AS "Article_Sentiment_Score", source_name AS "Source" """


@query("dashboard_articles", f"SELECT {_BOARD} FROM v_scored")
def dashboard_articles(desk: Desk):
    return board(desk)


@query("dashboard_filter", f"""
 SELECT {_BOARD} FROM v_scored WHERE CAST(published_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND source_name IN ('ptt', 'cnn')""")
def dashboard_filter(desk: Desk):
    return serving.dashboard_filter(board(desk), "2024-01-05", "2024-01-20", ["ptt", "cnn"])


# -- daily sentiment --------------------------------------------------------------------------
def _daily(days: int) -> str:
    return f"""(SELECT summary_date, source_name, CAST(sum(total_articles) AS BIGINT) AS total_articles,
      CAST(sum(scored_articles) AS BIGINT) AS scored_articles,
      CAST(sum(avg_sentiment * scored_articles) AS DOUBLE) / nullif(sum(scored_articles), 0) AS avg_sentiment
     FROM v_mart_daily WHERE summary_date <= DATE '{TODAY}' AND summary_date > DATE '{TODAY}' - INTERVAL {days} DAY
      AND avg_sentiment IS NOT NULL GROUP BY 1, 2)"""


_BY_DATE = f"""(SELECT summary_date, sum(avg_sentiment * scored_articles) / sum(scored_articles) AS score FROM {_daily(7)} GROUP BY 1)"""
_DAILY_SQL = f"""SELECT {day("summary_date")} AS summary_date, source_name, total_articles, scored_articles, {fx("avg_sentiment")} AS avg_sentiment
 FROM {_daily(30)}"""


@query("daily_sentiment", _DAILY_SQL)
def daily_sentiment(desk: Desk):
    return serving.daily_sentiment(mart(desk), today(), 30)


@query("daily_sentiment_function", _DAILY_SQL)
def daily_sentiment_function(desk: Desk):
    """The same query through the SQL table function."""
    mart(desk).createOrReplaceTempView("mart_daily_summary")
    desk.spark.sql(serving.daily_sentiment_sql("mart_daily_summary"))
    return desk.spark.sql(f"SELECT * FROM daily_sentiment(DATE'{TODAY}', 30)")


@query("sentiment_today", f"""
 SELECT {day("max(summary_date)")} AS date, {fx("arg_max(score, summary_date)", 2)} AS sentiment_score FROM {_BY_DATE}""")
def sentiment_today(desk: Desk):
    return serving.sentiment_today(mart(desk), today())


@query("sentiment_change", f"""
 SELECT {fx("score - before", 2)} AS change_sentiment_score FROM (
  SELECT score, lag(score) OVER (ORDER BY summary_date) AS before, row_number() OVER (ORDER BY summary_date DESC) AS rn FROM {_BY_DATE})
 WHERE rn = 1 AND before IS NOT NULL""")
def sentiment_change(desk: Desk):
    return serving.sentiment_change(mart(desk), today())


@query("sentiment_recent", f"""
 SELECT CAST(10 AS BIGINT) AS period, {fx("sum(avg_sentiment * scored_articles) / sum(scored_articles)", 2)} AS sentiment_score
 FROM {_daily(10)}""")
def sentiment_recent(desk: Desk):
    return serving.sentiment_recent(mart(desk), today(), 10)


# -- articles ------------------------------------------------------------------------------------
@query("top_push", f"""
 SELECT title AS "Title", CAST(push_count AS BIGINT) AS "Push_count", {ts("published_at")} AS "Published_Time", url AS "Url"
 FROM v_scored WHERE CAST(published_at AS DATE) >= (SELECT max(CAST(published_at AS DATE)) FROM v_scored) - INTERVAL 14 DAY
 ORDER BY push_count DESC NULLS LAST, article_id LIMIT 50""")
def top_push(desk: Desk):
    return serving.top_push(scored(desk), limit=50, period=2, period_type="week")


@query("search_articles", f"""
 SELECT title AS "Title", coalesce(CAST(push_count AS BIGINT), 0) AS "Push_count", {ts("published_at")} AS "Published_Time", url AS "Url"
 FROM v_scored WHERE contains(lower(title), 'se item 1')""")
def search_articles(desk: Desk):
    return serving.search(scored(desk), "SE Item 1")


@query("top_engagement", f"""
 SELECT title AS "Title", source_name AS "Source", CAST(push_count AS BIGINT) AS "Push_count", {fx("score")} AS "Article_Sentiment_Score",
  {day("published_at")} AS "Date" FROM v_scored ORDER BY push_count DESC NULLS LAST, article_id LIMIT 20""")
def top_engagement(desk: Desk):
    return serving.most_engaged(board(desk), 20)


# -- dashboard -------------------------------------------------------------------------------------
@query("trend_daily", f"""SELECT {day("published_at")} AS "Date", {fx("avg(score)")} AS avg_sentiment FROM v_scored GROUP BY 1""")
def trend_daily(desk: Desk):
    return serving.trend_daily(board(desk))


@query("count_daily", f"""SELECT {day("published_at")} AS "Date", count(*) AS articles FROM v_scored GROUP BY 1""")
def count_daily(desk: Desk):
    return serving.count_daily(board(desk))


@query("sentiment_by_source", f"""
 SELECT source_name AS "Source", {fx("avg(score)")} AS mean, count(*) AS count FROM v_scored GROUP BY 1""")
def sentiment_by_source(desk: Desk):
    return serving.sentiment_by_source(board(desk))


@query("dashboard_headline", f"""
 SELECT {day("l.d")} AS date, {fx("l.mean", 2)} AS score, coalesce({fx(f"{fx('l.mean', 2)} - b.mean", 2)}, 0.0) AS delta
 FROM (SELECT max(d) AS d, arg_max(mean, d) AS mean FROM (SELECT CAST(published_at AS DATE) AS d, avg(score) AS mean FROM v_scored GROUP BY 1)) l
 LEFT JOIN (SELECT CAST(published_at AS DATE) AS d, avg(score) AS mean FROM v_scored GROUP BY 1) b ON b.d = l.d - 1""")
def dashboard_headline(desk: Desk):
    return serving.dashboard_headline(board(desk))


_TERMS = r"""
 docs AS (SELECT article_id, regexp_extract_all(lower(title), '[\p{L}\p{N}_]{2,}') AS w FROM {top}),
 terms AS (SELECT article_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM docs),
 tf AS (SELECT article_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
 voc AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY 1 ORDER BY total DESC, term LIMIT 2000),
 wt AS (SELECT article_id, tf.term, tf * (ln((1 + (SELECT count(*) FROM docs)) / (1 + df)) + 1) AS x FROM tf JOIN voc ON voc.term = tf.term),
 nm AS (SELECT article_id, sqrt(sum(x * x)) AS norm FROM wt GROUP BY 1)
 SELECT term AS "Word", round(s, 3) AS "Score" FROM (SELECT term, sum(x / norm) AS s FROM wt JOIN nm ON nm.article_id = wt.article_id GROUP BY 1)
 ORDER BY round(s, 9) DESC, term DESC LIMIT 20"""


@query("top_keywords", "SELECT * FROM (WITH " + _TERMS.replace(
    "{top}", "(SELECT * FROM v_scored ORDER BY push_count DESC NULLS LAST, article_id LIMIT 200)") + ")")
def top_keywords(desk: Desk):
    """Keywords of the 200 most pushed titles, which is what the report shows."""
    top = board(desk).orderBy(F.desc_nulls_last("Push_count"), "Article_id").limit(keywords.MAX_DOCS)
    return keywords.top_keywords(top, "Article_id", "Title", max_terms=keywords.MAX_TERMS)


@query("corpus_keywords", "SELECT * FROM (WITH " + _TERMS.replace("{top}", "v_texts").replace("lower(title)", "lower(content)").replace("ORDER BY total DESC, term LIMIT 2000", "") + ")")
def corpus_keywords(desk: Desk):
    """The same ranking over the whole texts of the whole corpus."""
    return keywords.top_keywords(desk.texts(spread=False), "article_id", "content")


# -- sentiment against prices -------------------------------------------------------------------------
def long_mart(desk: Desk):
    """Daily mart over years of posts."""
    daily = desk.articles_long().groupBy(c("date").alias("summary_date"), "source_name").agg(
        F.count(F.lit(1)).alias("total_articles"), F.count("score").alias("scored_articles"),
        F.round(F.avg("score"), 10).cast("decimal(6,4)").alias("avg_sentiment"))
    return daily


def symbol(desk: Desk, name: str):
    return prices.with_changes(desk.prices()).where(c("symbol") == name)


@query("sentiment_vs_next_day", f"""
 SELECT {day("d")} AS sentiment_date, {fx("s")} AS avg_sentiment, CAST(p.change AS DOUBLE) AS next_day_change FROM (
  SELECT d, CAST(sum(a * n) AS DOUBLE) / nullif(sum(n), 0) AS s FROM (
   SELECT date AS d, source_name, count(score) AS n, CAST(CAST(avg(score) AS DECIMAL(38,10)) AS DECIMAL(6,4)) AS a FROM v_long GROUP BY 1, 2)
  WHERE a IS NOT NULL AND d >= DATE '2001-11-04' - INTERVAL 365 DAY GROUP BY 1)
 JOIN v_price_changes p ON p.symbol = '0050' AND p.trade_date = d + 1""")
def sentiment_vs_next_day(desk: Desk):
    return serving.sentiment_vs_next_day(long_mart(desk), symbol(desk, "0050"), F.lit("2001-11-04").cast("date"), 365)


def _market_pairs(market: str, instrument: str) -> str:
    return f"""SELECT '{market}' AS market, d, s, CAST(p.change AS DOUBLE) AS change FROM (
      SELECT date AS d, avg(score) AS s FROM v_long WHERE market = '{market}' AND score IS NOT NULL GROUP BY 1)
     JOIN v_price_changes p ON p.symbol = '{instrument}' AND p.trade_date = d + 1"""


def market_pairs(desk: Desk):
    parts = [serving.sentiment_vs_next_day_market(desk.articles_long(), symbol(desk, s), m).withColumn("market", F.lit(m))
             for m, s in config.MARKET_INSTRUMENT.items()]
    return parts[0].unionByName(parts[1])


@query("sentiment_vs_next_day_market", f"""
 SELECT market, {day("d")} AS sentiment_date, {fx("s")} AS avg_sentiment, change AS next_day_change
 FROM ({_market_pairs("TW", "0050")} UNION ALL {_market_pairs("US", "VOO")})""")
def sentiment_vs_next_day_market(desk: Desk):
    return market_pairs(desk)


# -- prices -------------------------------------------------------------------------------------------
@query("price_changes", f"""
 SELECT symbol, {day("trade_date")} AS trade_date, CAST(close AS DOUBLE) AS close, CAST(change AS DOUBLE) AS change FROM v_price_changes""")
def price_changes(desk: Desk):
    return prices.with_changes(desk.prices())


@query("price_window", f"""
 SELECT symbol, {day("trade_date")} AS trade_date, CAST(close AS DOUBLE) AS close FROM v_prices
 WHERE symbol = '0050' AND trade_date >= DATE '1996-01-01' AND trade_date < DATE '1997-07-01'""")
def price_window(desk: Desk):
    return prices.between(desk.prices(), "0050", "1996-01-01", "1997-07-01")


@query("next_day_return", f"""
 SELECT symbol, {day("trade_date")} AS trade_date, close, {fx("next_return")} AS next_return, CAST(next_day_up AS BIGINT) AS next_day_up
 FROM v_returns""")
def next_day_return(desk: Desk):
    return prices.next_day_returns(desk.prices())


# -- set operations ---------------------------------------------------------------------------------
@query("union_sources", f"""
 SELECT url, title, {ts("published_at")} AS published_at, source_name FROM v_articles WHERE source_name IN ('ptt', 'reddit')
 UNION ALL SELECT 'https://news.example.com/d/' || article_id, title, NULL, source_name FROM v_texts""")
def union_sources(desk: Desk):
    named = desk.articles().join(desk.sources().where("has_push_count").select("source_id", "source_name"), "source_id")
    texts = desk.texts().select(F.concat(F.lit("https://news.example.com/d/"), c("article_id").cast("string")).alias("url"),
                                "title", F.lit(None).cast("timestamp_ntz").alias("published_at"), "source_name")
    return named.select("url", "title", "published_at", "source_name").unionByName(texts)


@query("new_urls", """
 SELECT DISTINCT url FROM v_extracted WHERE url NOT IN (SELECT url FROM v_scored)""")
def new_urls(desk: Desk):
    """Delivered addresses that are not stored with a score yet."""
    listed = desk.raw_articles().select(F.get_json_object("raw_payload", "$.url").alias("url")).distinct()
    known = desk.articles().join(desk.scores().select("article_id"), "article_id", "left_semi")
    return dedup.absent_from(listed, known, ["url"])


@query("duplicate_urls", "SELECT url, count(*) AS n FROM v_extracted GROUP BY 1 HAVING count(*) > 1")
def duplicate_urls(desk: Desk):
    return dedup.duplicates(desk.raw_articles().select(F.get_json_object("raw_payload", "$.url").alias("url")), ["url"])
