"""The domain tables in SQL, independent of the Spark code that builds the same tables."""

from __future__ import annotations

from catalog.base import VIEWS, day, settle, view

DAY, CLOCK = "[0-9]{4}-[0-9]{2}-[0-9]{2}", "[0-9]{2}:[0-9]{2}:[0-9]{2}"
MAIL = rf"^[A-Za-z]{{3}},\s+([0-9]{{1,2}}\s+[A-Za-z]{{3}}\s+[0-9]{{4}}\s+{CLOCK})"
MAIL_SOURCES = "('cnn','wsj','marketwatch','wayback_cnn','wayback_wsj')"


def parse_date(t: str, source: str) -> str:
    return f"""CASE WHEN ({t}) IS NULL OR trim({t}) = '' THEN NULL
      WHEN {source} = 'ptt' AND regexp_matches({t}, '^{DAY}[T ]{CLOCK}')
        THEN TRY_CAST(replace(substr({t},1,19),'T',' ') AS TIMESTAMP) - INTERVAL 8 HOUR
      WHEN {source} = 'reddit' AND regexp_matches({t}, '^[0-9]+(\\.[0-9]+)?$')
        THEN make_timestamp(CAST(round(TRY_CAST({t} AS DOUBLE) * 1e6) AS BIGINT))
      WHEN {source} IN {MAIL_SOURCES} AND regexp_matches({t}, '{MAIL}')
        THEN try_strptime(regexp_extract({t}, '{MAIL}', 1), '%d %b %Y %H:%M:%S')
      WHEN regexp_matches({t}, '^{DAY}[T ]{CLOCK}') THEN TRY_CAST(replace(substr({t},1,19),'T',' ') AS TIMESTAMP)
      WHEN regexp_matches({t}, '^{DAY}') THEN TRY_CAST(substr({t},1,10) AS TIMESTAMP) END"""


view("v_sources", """
 SELECT * FROM (VALUES
  (1,'ptt','https://www.ptt.cc/bbs/Stock','TW','0050',true,'zh','signup'),
  (2,'cnyes','https://news.cnyes.com/news/cat/tw_stock','TW','0050',false,'zh','click'),
  (3,'reddit','https://www.reddit.com/r/investing+stocks+wallstreetbets+Bogleheads+personalfinance+financialindependence',
     'US','VOO',true,'en','view'),
  (4,'cnn','https://edition.cnn.com/business','US','VOO',false,'en','purchase'),
  (5,'wsj','https://www.wsj.com/news/markets','US','VOO',false,'en','error'))
 AS t(source_id, source_name, url, market_code, tracked_stock, has_push_count, lang, kind)""")

view("v_articles", """
 SELECT event_id AS article_id, s.source_id, s.source_name, s.market_code,
  'https://news.example.com/a/' || event_id AS url, event_type || ' item ' || user_id AS title,
  'user' || user_id AS author, props AS content,
  CASE WHEN event_type IN ('signup','view')
       THEN CAST(least(100, greatest(-100, floor(value) - 50)) AS INTEGER) END AS push_count,
  ts AS published_at, ts + INTERVAL 1 HOUR AS scraped_at, value
 FROM events JOIN v_sources s ON s.kind = event_type""")

view("v_scores", """
 SELECT event_id AS article_id, round(least(1.0, greatest(-1.0, (value - 50) / 50)), 4) AS score,
  ts + INTERVAL 2 HOUR AS calculated_at
 FROM events WHERE value >= 5""")

view("v_comments", """
 SELECT conv_id * 1000 + turn AS comment_id, CASE WHEN role = 'system' THEN -1 - conv_id ELSE conv_id END AS article_id,
  role AS author, CASE role WHEN 'user' THEN '推' WHEN 'assistant' THEN '→' WHEN 'system' THEN '噓' END AS push_tag,
  text AS message
 FROM conversations""")

view("v_published_text", """
 SELECT event_id, CASE event_type WHEN 'signup' THEN strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')
   WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 'view' THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
   ELSE strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' GMT' END AS published_text
 FROM events""")

view("v_raw_articles", """
 SELECT a.event_id * 2 + a.delivery AS raw_id, s.source_name,
  to_json({'url': 'https://news.example.com/a/' || a.event_id,
           'title': event_type || ' item ' || user_id || CASE WHEN delivery = 2 THEN ' v2' ELSE '' END,
           'author': 'user' || user_id, 'content': props,
           'push_count': CASE WHEN event_type IN ('signup','view')
                              THEN CAST(least(100, greatest(-100, floor(value) - 50)) AS INTEGER) END,
           'published_at': p.published_text,
           'scraped_at': CASE WHEN value >= 10 THEN strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') END}) AS raw_payload,
  CASE WHEN delivery = 2 THEN ts + INTERVAL 25 HOUR ELSE ts + INTERVAL 1 HOUR END AS ingested_at
 FROM (SELECT *, unnest(CASE WHEN value > 90 THEN [1, 2] ELSE [1] END) AS delivery FROM events) a
 JOIN v_sources s ON s.kind = a.event_type JOIN v_published_text p ON p.event_id = a.event_id""")

view("v_raw_scores", """
 SELECT event_id * 2 + delivery AS raw_id, 'https://news.example.com/a/' || event_id AS article_id_raw,
  printf('%.4f', CASE WHEN delivery = 2 THEN round(score / 2, 4) ELSE score END) AS score_text,
  strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') AS calculated_text,
  CASE WHEN delivery = 2 THEN ts + INTERVAL 26 HOUR ELSE ts + INTERVAL 2 HOUR END AS ingested_at
 FROM (SELECT *, round(least(1.0, greatest(-1.0, (value - 50) / 50)), 4) AS score,
              unnest(CASE WHEN value < 15 THEN [1, 2] ELSE [1] END) AS delivery
       FROM events WHERE value >= 5)""")

view("v_raw_sources", """
 SELECT event_id + 1 AS raw_id, CASE WHEN value > 50 THEN ' ' || upper(source_name) || ' ' ELSE source_name END AS source_name,
  s.url, ts + INTERVAL 1 HOUR AS ingested_at
 FROM events JOIN v_sources s ON s.kind = event_type""")

_P = "raw_payload ->> "
view("v_extracted", f"""
 SELECT raw_id, source_name, ingested_at, nullif(trim({_P}'$.url'), '') AS url, nullif(trim({_P}'$.title'), '') AS title,
  nullif(trim({_P}'$.author'), '') AS author_raw, nullif({_P}'$.content', '') AS content,
  CASE WHEN regexp_matches({_P}'$.push_count', '^-?[0-9]+$') THEN TRY_CAST({_P}'$.push_count' AS INTEGER) END AS push_count,
  {parse_date(f"({_P}'$.published_at')", "source_name")} AS published_at,
  {parse_date(f"({_P}'$.scraped_at')", "source_name")} AS scraped_raw
 FROM v_raw_articles""")

view("v_stg_articles", """
 SELECT first_id AS article_id, url, source_name, title,
  substr(sha256('change-me-in-production:' || author_raw), 1, 16) AS author_hash, content, push_count, published_at,
  coalesce(scraped_raw, ingested_at) AS scraped_at, ingested_at AS ingest_time
 FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ingested_at DESC, raw_id DESC) AS rn,
              min(raw_id) OVER (PARTITION BY url) AS first_id FROM v_extracted WHERE url IS NOT NULL)
 WHERE rn = 1""")

view("v_odd_extracted", """
 SELECT * REPLACE (CASE WHEN raw_id % 23 = 0 THEN NULL WHEN raw_id % 29 = 0 THEN -raw_id WHEN raw_id % 31 = 0 THEN raw_id - 2 ELSE raw_id END AS raw_id)
 FROM (SELECT * FROM v_extracted UNION ALL SELECT * FROM v_extracted WHERE raw_id % 37 IN (0, 1))""")

view("v_odd_stg_articles", VIEWS["v_stg_articles"].replace("FROM v_extracted", "FROM v_odd_extracted").replace("raw_id DESC", "raw_id DESC NULLS LAST"))

view("v_stg_scores", """
 SELECT sha256(article_id_raw) AS score_id, article_id_raw, CAST(score_text AS DOUBLE) AS score,
  CAST(replace(calculated_text, 'T', ' ') AS TIMESTAMP) AS calculated_at, ingested_at AS ingest_time
 FROM (SELECT *, row_number() OVER (PARTITION BY article_id_raw ORDER BY ingested_at DESC, raw_id DESC) AS rn
       FROM v_raw_scores) WHERE rn = 1""")

view("v_stg_sources", """
 SELECT first_id AS source_id, name AS source_name, url AS source_url, ingested_at AS ingest_time
 FROM (SELECT *, trim(lower(source_name)) AS name,
              row_number() OVER (PARTITION BY trim(lower(source_name)) ORDER BY ingested_at DESC, raw_id DESC) AS rn,
              min(raw_id) OVER (PARTITION BY trim(lower(source_name))) AS first_id FROM v_raw_sources) WHERE rn = 1""")

view("v_int_articles", """
 SELECT a.*, s.score AS sentiment_score, s.calculated_at AS sentiment_score_calculated_at
 FROM v_stg_articles a LEFT JOIN v_stg_scores s ON s.article_id_raw = a.url""")

view("v_fact", f"""
 SELECT CAST(a.published_at AS DATE) AS fact_date, a.source_id, s.tracked_stock AS stock_symbol, s.source_name,
  count(a.article_id) AS article_count, count(*) FILTER (WHERE ss.score IS NOT NULL) AS scored_articles,
  {settle('avg(ss.score)', 6, 4)} AS avg_sentiment, {settle('avg(a.push_count)', 8, 2)} AS avg_push_count
 FROM v_articles a JOIN v_sources s ON s.source_id = a.source_id LEFT JOIN v_scores ss ON ss.article_id = a.article_id
 GROUP BY 1, 2, 3, 4""")

view("v_mart_daily", f"""
 SELECT fact_date AS summary_date, source_name, CAST(sum(article_count) AS BIGINT) AS total_articles,
  CAST(sum(scored_articles) AS BIGINT) AS scored_articles,
  {settle('CAST(sum(avg_sentiment * scored_articles) AS DOUBLE) / nullif(sum(scored_articles), 0)', 6, 4)} AS avg_sentiment,
  {settle('CAST(sum(avg_push_count * article_count) AS DOUBLE) / nullif(sum(article_count), 0)', 8, 2)} AS avg_push_count
 FROM v_fact GROUP BY 1, 2""")

_MOOD = """count(*) AS article_count, count(*) FILTER (WHERE score > 0.2) AS pos_count,
  count(*) FILTER (WHERE score < -0.2) AS neg_count, count(*) FILTER (WHERE score BETWEEN -0.2 AND 0.2) AS neu_count,
  avg(score) AS avg_score"""
view("v_fact_mood", f"""
 SELECT CAST(a.scraped_at AS DATE) AS fact_date, a.source_id, a.source_name, {_MOOD}
 FROM v_articles a JOIN v_scores ss ON ss.article_id = a.article_id GROUP BY 1, 2, 3""")
view("v_fact_mood_v2", f"""
 SELECT CAST(j.scraped_at AS DATE) AS fact_date, s.source_id, j.source_name, {_MOOD}, 'v2' AS pipeline_version
 FROM (SELECT *, sentiment_score AS score FROM v_int_articles WHERE sentiment_score IS NOT NULL) j
 LEFT JOIN v_stg_sources s ON s.source_name = j.source_name GROUP BY 1, 2, 3""")

view("v_scored", """
 SELECT a.*, s.score FROM v_articles a JOIN v_scores s ON s.article_id = a.article_id""")

view("v_prices", """
 SELECT symbol, trade_date,
  CAST(CAST((2 * total + 1000 * n) // (2000 * n) AS DECIMAL(18,0)) / 100 AS DECIMAL(10,2)) AS close
 FROM (SELECT symbol, CAST(o_orderdate AS DATE) AS trade_date, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total,
              count(*) AS n
       FROM (SELECT *, unnest(CASE WHEN o_orderpriority = '1-URGENT' THEN ['0050','VOO'] ELSE ['0050'] END) AS symbol
             FROM orders WHERE isodow(o_orderdate) <= 5) GROUP BY 1, 2)""")

view("v_price_changes", """
 SELECT symbol, trade_date, close, close - lag(close) OVER (PARTITION BY symbol ORDER BY trade_date) AS change
 FROM v_prices""")

view("v_returns", """
 SELECT *, CAST(next_return > 0 AS INTEGER) AS next_day_up
 FROM (SELECT symbol, trade_date, CAST(close AS DOUBLE) AS close,
   (lead(CAST(close AS DOUBLE)) OVER w - CAST(close AS DOUBLE)) / CAST(close AS DOUBLE) AS next_return
  FROM v_prices WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)) WHERE next_return IS NOT NULL""")

view("v_long", """
 SELECT CAST(l_shipdate AS DATE) AS date,
  CASE l_returnflag WHEN 'R' THEN 'ptt' WHEN 'A' THEN 'reddit' WHEN 'N' THEN 'cnn' END AS source_name,
  CASE l_returnflag WHEN 'R' THEN 'TW' ELSE 'US' END AS market,
  CASE WHEN l_tax < 0.08 THEN (CAST(round(l_discount * 100) AS INTEGER) - 5) / 5.0 END AS score,
  CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS INTEGER) END AS push_count
 FROM lineitem""")

view("v_daily_base", """
 SELECT market, date, avg(score) AS avg_sentiment, count(*) AS article_count, avg(coalesce(push_count, 0)) AS avg_push_count
 FROM v_long GROUP BY 1, 2""")

view("v_features", """
 SELECT * FROM (
  SELECT b.market, b.date, r.close, r.next_return, r.next_day_up, b.avg_sentiment, b.article_count, b.avg_push_count,
   lag(b.avg_sentiment) OVER d AS sentiment_yesterday,
   CASE WHEN count(b.avg_sentiment) OVER w = 3 THEN avg(b.avg_sentiment) OVER w END AS sentiment_3day_avg,
   CASE WHEN count(b.avg_push_count) OVER w = 3 THEN avg(b.avg_push_count) OVER w END AS push_count_3day_avg,
   CASE WHEN count(b.article_count) OVER w = 3 THEN avg(b.article_count) OVER w END AS article_count_3day_avg
  FROM v_daily_base b JOIN v_returns r
    ON r.trade_date = b.date AND r.symbol = CASE b.market WHEN 'TW' THEN '0050' ELSE 'VOO' END
  WINDOW d AS (PARTITION BY b.market ORDER BY b.date),
         w AS (PARTITION BY b.market ORDER BY b.date ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
 WHERE avg_sentiment IS NOT NULL AND sentiment_yesterday IS NOT NULL AND sentiment_3day_avg IS NOT NULL
  AND push_count_3day_avg IS NOT NULL AND article_count_3day_avg IS NOT NULL""")

view("v_folds", """
 WITH RECURSIVE f AS (
  SELECT market, last_day, 0 AS fold, CAST(first_day + INTERVAL 3 MONTH AS DATE) AS train_end FROM
   (SELECT market, min(date) AS first_day, max(date) AS last_day FROM v_features GROUP BY 1)
  UNION ALL SELECT market, last_day, fold + 1, CAST(train_end + INTERVAL 3 MONTH AS DATE) FROM f
   WHERE CAST(train_end + INTERVAL 3 MONTH AS DATE) < last_day)
 SELECT market, fold, train_end, CAST(train_end + INTERVAL 3 MONTH AS DATE) AS test_end FROM f WHERE train_end < last_day""")

view("v_predictions", """
 SELECT x.market, x.date, x.close, x.next_return, x.next_day_up AS true_up,
  CASE WHEN round(x.avg_sentiment, 9) >= round(x.sentiment_3day_avg, 9) THEN 1 ELSE 0 END AS pred
 FROM v_features x JOIN v_folds f ON f.market = x.market AND x.date >= f.train_end AND x.date < f.test_end""")

view("v_curve", """
 SELECT *, product(1 + next_return * (CASE WHEN pred = 1 THEN 1.0 ELSE 0.0 END)) OVER w AS strategy_cumulative_return,
  close / first_value(close) OVER w AS buy_and_hold_return
 FROM v_predictions WINDOW w AS (PARTITION BY market ORDER BY date)""")

view("v_texts", """
 SELECT doc_id AS article_id, string_split(text, chr(10))[1] AS title, text AS content, source AS source_name, lang
 FROM documents""")

view("v_labels", """
 SELECT doc_id AS article_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS label,
  make_timestamp((1704067200 + doc_id) * 1000000) AS labeled_at
 FROM labels""")

__all__ = ["DAY", "CLOCK", "MAIL", "day", "parse_date"]

# -- the tables after several batches of changes -----------------------------------------------------
view("v_moved_articles", """
 SELECT * REPLACE (CASE WHEN article_id % 10 = 0 THEN CAST(1 + source_id % 5 AS INTEGER) ELSE source_id END AS source_id,
                   CASE WHEN article_id % 10 = 0 THEN published_at + INTERVAL 1 DAY ELSE published_at END AS published_at)
 FROM v_articles WHERE article_id % 25 <> 1""")

view("v_kept_scores", "SELECT * FROM v_scores WHERE article_id % 7 <> 3")

view("v_late_fact", VIEWS["v_fact"].replace("v_articles", "v_moved_articles").replace("v_scores", "v_kept_scores"))

view("v_late_mart", VIEWS["v_mart_daily"].replace("v_fact", "v_late_fact"))
