"""Landing zone and feeds. Feed bodies are built by Spark out of the tables, one body per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalog.base import query, ts
from moodtide import config
from moodtide.session import shared_dir
from moodtide.sources import feeds, landing, parsers
from moodtide.sources.domain import Desk, epoch_seconds

c = F.col


def text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# -- raw rows ---------------------------------------------------------------------------------
@query("raw_articles_append", f"""
 SELECT source_name, CAST(to_json({{'title': title, 'content': content, 'url': url, 'author': author,
   'published_at': strftime(published_at, '%Y-%m-%d %H:%M:%S'), 'push_count': push_count}}) AS VARCHAR) AS raw_payload,
  {ts("scraped_at")} AS ingested_at FROM v_articles""")
def raw_articles_append(desk: Desk):
    named = desk.articles().join(desk.sources().select("source_id", "source_name"), "source_id")
    path = shared_dir(desk.spark, "raw-articles")
    landing.append(landing.raw_articles(named, c("source_name"), c("scraped_at")), path)
    return desk.spark.read.parquet(path).drop("ingest_day")


@query("raw_scores_append", f"""
 SELECT url AS article_id_raw, CAST(to_json({{'article_id_raw': CASE WHEN score > 0 THEN url END, 'url': url, 'score': printf('%.4f', score)}})
   AS VARCHAR) AS raw_payload, {ts("published_at + INTERVAL 2 HOUR")} AS ingested_at FROM v_scored""")
def raw_scores_append(desk: Desk):
    scored = desk.articles().select("article_id", "url").join(desk.scores(), "article_id")
    delivered = scored.select(F.when(c("score") > 0, c("url")).alias("article_id_raw"), "url",
                              F.format_string("%.4f", "score").alias("score"), c("calculated_at").alias("_at"))
    rows = landing.raw_scores(delivered, "_at")
    path = shared_dir(desk.spark, "raw-scores")
    landing.append(rows, path)
    return desk.spark.read.parquet(path).drop("ingest_day")


def _fetches(desk: Desk):
    """Pages fetched up to three times; the second answer is JSON."""
    first = F.struct(F.lit("2024-01-01T00:00:00").alias("fetched_at"), F.lit("text/html; charset=utf-8").alias("content_type"),
                     c("html").alias("body"))
    second = F.struct(F.lit("2024-01-02T00:00:00").alias("fetched_at"), F.lit("application/json").alias("content_type"),
                      F.to_json(F.struct("page_id")).alias("body"))
    third = F.struct(F.lit("2024-01-03T00:00:00").alias("fetched_at"), F.lit(None).cast("string").alias("content_type"),
                     text(c("html"), "<!-- again -->").alias("body"))
    times = F.array_compact(F.array(first, F.when(c("url").contains("?"), second), F.when(c("url").startswith("https"), third)))
    return desk.table("pages").select("url", F.explode(times).alias("f")).select(
        F.lit("cnn").alias("source"), "url", F.lit(200).alias("http_status"), "f.*")


@query("raw_responses_latest", """
 SELECT url, 'cnn' AS source, CASE WHEN starts_with(url, 'https') THEN '2024-01-03T00:00:00' WHEN contains(url, '?') THEN '2024-01-02T00:00:00'
   ELSE '2024-01-01T00:00:00' END AS fetched_at, CAST(200 AS BIGINT) AS http_status,
  CASE WHEN starts_with(url, 'https') THEN html || '<!-- again -->' ELSE html END AS raw_html,
  CASE WHEN contains(url, '?') THEN '{"page_id":' || page_id || '}' END AS raw_json FROM pages""")
def raw_responses_latest(desk: Desk):
    return landing.latest_responses(landing.response_document(_fetches(desk)))


@query("raw_backfill", f"""
 SELECT source_name, CAST(to_json({{'url': url, 'title': title, 'author': author, 'content': content, 'push_count': push_count,
   'published_at': strftime(published_at, '%Y-%m-%d %H:%M:%S'), 'scraped_at': strftime(scraped_at, '%Y-%m-%d %H:%M:%S'),
   'oltp_article_id': article_id, 'masked': true}}) AS VARCHAR) AS raw_payload, {ts("scraped_at")} AS ingested_at
 FROM v_articles WHERE published_at >= TIMESTAMP '2024-01-10'""")
def raw_backfill(desk: Desk):
    """The articles a first, shorter back-fill has not brought over."""
    early = desk.articles().where(c("published_at") < F.lit("2024-01-10").cast("timestamp_ntz"))
    none = desk.raw_articles().where(F.lit(False)).select("raw_payload")
    before = landing.backfill(early, desk.sources(), none, masked=True)
    return landing.backfill(desk.articles(), desk.sources(), before.select("raw_payload").unionByName(
        desk.raw_articles().select("raw_payload")), masked=True)


# -- sitemaps ------------------------------------------------------------------------------------
_NS = ('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" '
       'xmlns:news="http://www.google.com/schemas/sitemap-news/0.9">')


def _entry(loc: Column, title: Column, date: Column) -> Column:
    inner = F.concat(F.coalesce(text("<news:title>", title, "</news:title>"), F.lit("")),
                     F.coalesce(text("<news:publication_date>", date, "</news:publication_date>"), F.lit("")))
    return text("<url><loc>", loc, "</loc><news:news>", inner, "</news:news></url>")


def sitemaps(desk: Desk):
    """One sitemap per event: a complete entry (posts of type error lack the title) and one without date."""
    loc = text("https://www.wsj.com/articles/", c("event_id"))
    title = F.when(c("event_type") != "error", text(" ", c("event_type"), " &amp; ", c("user_id"), " "))
    day = text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "+08:00")
    return desk.spread("events").select(
        text("https://s.example/", c("event_id"), ".xml").alias("url"), "event_id", "value",
        text(_NS, _entry(loc, title, day), _entry(text(loc, "/b"), F.lit("no date"), F.lit(None).cast("string")), "</urlset>").alias("body"))


_ENTRIES = f"""SELECT event_id, 'https://www.wsj.com/articles/' || event_id AS url, event_type || ' & ' || user_id AS title,
  {ts("date_trunc('second', ts)")} AS published_at FROM events WHERE event_type <> 'error'"""


@query("sitemap_entries", _ENTRIES)
def sitemap_entries(desk: Desk):
    return feeds.sitemap_entries(sitemaps(desk), keep=("event_id",)).drop("position")


@query("sitemap_index", f"""
 SELECT 'https://s.example/index-' || event_id || '.xml' AS root, 'https://s.example/' || event_id || '.xml' AS sitemap, url, title, published_at
 FROM ({_ENTRIES})""")
def sitemap_index(desk: Desk):
    """Indexes of one or six levels over the sitemaps; some listed documents were never landed."""
    maps = sitemaps(desk)
    listed = lambda loc: text("<sitemap><loc>", loc, "</loc></sitemap>")
    index = lambda *parts: text("<sitemapindex>", *parts, "</sitemapindex>")
    missing = text("https://s.example/gone-", c("event_id"), ".xml")
    sub = lambda level: text(f"https://s.example/sub{level}-", c("event_id"), ".xml")
    deep = c("value") > 100
    roots = maps.select(text("https://s.example/index-", c("event_id"), ".xml").alias("url"),
                        index(listed(F.when(deep, sub(1)).otherwise(c("url"))), listed(missing)).alias("body"))
    chain = F.explode(F.array(*[F.struct(sub(i).alias("url"), index(listed(c("url") if i == 5 else sub(i + 1))).alias("body")) for i in range(1, 6)]))
    subs = maps.where(deep).select(chain.alias("s")).select("s.*")
    return feeds.expand_index(roots, maps.select("url", "body").unionByName(subs)).select(
        "root", "sitemap", "url", "title", "published_at")


@query("sitemap_dedup", f"""
 WITH news AS (SELECT 'https://edition.cnn.com/' || strftime(ts, '%Y/%m/%d') || '/business/' || user_id AS url, event_type AS title,
   date_trunc('second', ts) AS published_at, event_id AS position FROM events WHERE event_type IN ('click', 'view')),
  mon AS (SELECT 'https://edition.cnn.com/' || strftime(ts, '%Y/%m/%d') || '/business/' || user_id AS url, date_trunc('day', ts) AS published_at,
   event_id AS position FROM events)
 SELECT url, title, {ts("published_at")} AS published_at, CAST(0 AS BIGINT) AS needs_full_fetch FROM (
   SELECT *, row_number() OVER (PARTITION BY url ORDER BY position DESC) AS rn FROM news) WHERE rn = 1
 UNION ALL SELECT url, '', {ts("min(published_at)")}, 1 FROM mon WHERE url NOT IN (SELECT url FROM news) GROUP BY 1""")
def sitemap_dedup(desk: Desk):
    """News and month feed of one site: addresses repeat within and across them."""
    loc = text("https://edition.cnn.com/", F.date_format("ts", "yyyy/MM/dd"), "/business/", c("user_id"))
    day = text(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "Z")
    doc = lambda entry: text(_NS, entry, "</urlset>").alias("body")
    news = desk.table("events").where(c("event_type").isin("click", "view")).select("event_id", doc(_entry(loc, c("event_type"), day)))
    month = desk.table("events").select("event_id", doc(text("<url><loc>", loc, "</loc></url>")))
    placed = lambda df: df.drop("position").withColumnRenamed("event_id", "position")
    return feeds.merge_feeds(placed(feeds.sitemap_entries(news, keep=("event_id",))),
                             placed(feeds.month_entries(month, keep=("event_id",))))


# -- listing APIs --------------------------------------------------------------------------------
def news_listings(desk: Desk):
    """One listing page per event: a usable item, one without time, and one with only a summary for low values."""
    def item(number: Column, content: Column, summary: Column, at: Column) -> Column:
        return F.struct(number.alias("newsId"), text(" ", c("event_type"), " ", c("user_id"), " ").alias("title"),
                        content.alias("content"), summary.alias("summary"), F.lit(None).cast("string").alias("author"),
                        at.alias("publishAt"))
    body = text("<p>", c("event_type"), "&nbsp;&amp; <b>news</b></p><p>of ", c("user_id"), "</p>")
    none = F.lit(None).cast("string")
    at = epoch_seconds(c("ts"))
    low = c("value") < 50
    items = F.array(
        item(c("event_id") * 2 + 1, F.when(low, none).otherwise(body), F.when(low, body), at),
        item(c("event_id") * 2 + 2, body, none, F.lit(None).cast("bigint")))
    return desk.spread("events").select("event_id", "value", F.to_json(F.struct(F.struct(items.alias("data")).alias("items")),
                                                            {"ignoreNullFields": "false"}).alias("body"))


@query("listing_news", f"""
 SELECT event_id, event_id * 2 + k AS "newsId", ' ' || event_type || ' ' || user_id || ' ' AS title,
  CASE WHEN k = 1 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS "publishAt" FROM events, (VALUES (1), (2)) t(k)""")
def listing_news(desk: Desk):
    return feeds.news_items(news_listings(desk), keep=("event_id",)).select("event_id", "newsId", "title", "publishAt")


@query("parse_news_item", f"""
 SELECT event_id, event_type || ' ' || user_id AS title, event_type || chr(160) || '& ' || chr(10) || 'news' || chr(10) || 'of ' || user_id AS content,
  'https://news.cnyes.com/news/id/' || (event_id * 2 + 1) AS url, {ts("date_trunc('second', ts)")} AS published_at FROM events""")
def parse_news_item(desk: Desk):
    items = feeds.news_items(news_listings(desk), keep=("event_id",))
    return parsers.news_item(items, keep=("event_id",)).drop("author")


def _post() -> Column:
    kind = c("event_type")
    body = F.when(kind == "click", "[removed]").when(kind == "view", "[deleted]").otherwise(text("  body of ", c("user_id"), "\n"))
    created = F.when(kind == "error", "not a time").otherwise(epoch_seconds(c("ts")).cast("string"))
    return F.struct(
        F.when(kind != "signup", c("event_id").cast("string")).alias("id"), text(" ", kind, " ").alias("title"), body.alias("selftext"),
        text("/r/stocks/comments/", c("event_id"), "/x/").alias("permalink"), text("user", c("user_id")).alias("author"),
        created.alias("created_utc"), F.when(c("value") > 5, F.floor(c("value") * 2) - 100).alias("score"))


def forum_listings(desk: Desk):
    post = _post()
    return desk.spread("events").select(
        "event_id", F.to_json(F.struct(F.struct(F.array(F.struct(post.alias("data"))).alias("children"), F.lit("t3").alias("after"))
                                       .alias("data"))).alias("body"),
        F.to_json(F.struct(F.when(c("value") > 150, "too many requests").alias("error"), F.array(post).alias("data"))).alias("bulk"))


_POSTS = """SELECT event_id, event_type, CASE WHEN event_type <> 'signup' THEN CAST(event_id AS VARCHAR) END AS id,
  CASE WHEN value > 5 THEN CAST(floor(value * 2) AS BIGINT) - 100 END AS score FROM events"""


@query("listing_forum", f"""
 SELECT 'listing' AS kind, event_id, id, score FROM ({_POSTS}) UNION ALL
 SELECT 'bulk', event_id, id, score FROM ({_POSTS}) WHERE event_id IN (SELECT event_id FROM events WHERE value <= 150)""")
def listing_forum(desk: Desk):
    docs = forum_listings(desk)
    one = feeds.forum_posts(docs, keep=("event_id",)).select(F.lit("listing").alias("kind"), "event_id", "id", "score")
    return one.unionByName(feeds.bulk_posts(docs, body="bulk", keep=("event_id",)).select(
        F.lit("bulk").alias("kind"), "event_id", "id", "score"))


@query("parse_forum_post", f"""
 SELECT event_id, event_type AS title, CASE WHEN event_type = 'purchase' THEN 'body of ' || user_id ELSE '' END AS content,
  'https://www.reddit.com/r/stocks/comments/' || event_id || '/x/' AS url, 'user' || user_id AS author,
  CAST(CASE WHEN value > 5 THEN least(100, greatest(-100, floor(value * 2) - 100)) ELSE 0 END AS BIGINT) AS push_count,
  {ts("date_trunc('second', ts)")} AS published_at FROM events WHERE event_type NOT IN ('signup', 'error')""")
def parse_forum_post(desk: Desk):
    return parsers.forum_post(feeds.forum_posts(forum_listings(desk), keep=("event_id",)), keep=("event_id",))


# -- archive index -----------------------------------------------------------------------------------
def index_answers(desk: Desk):
    """One answer per event with changing column order, a foreign address, a short row, and no rows for type error."""
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    page = text("http://www.cnn.com/", F.date_format("ts", "yyyy/MM/dd"), "/x/", c("user_id"), "/?utm_source=a&p=", c("event_type"))
    table = lambda a, b, first, second: F.array(
        F.array(F.lit("urlkey"), F.lit(a), F.lit(b)), F.array(F.lit("k"), first, second),
        F.array(F.lit("k"), F.lit("20200101000000"), F.lit("https://elsewhere.example/")), F.array(F.lit("k"), F.lit("x")))
    body = (F.when(c("event_type") == "error", F.to_json(F.array(F.array(F.lit("urlkey"), F.lit("timestamp"), F.lit("original")))))
            .when(c("event_type") == "click", F.to_json(table("original", "timestamp", page, stamp)))
            .otherwise(F.to_json(table("timestamp", "original", stamp, page))))
    return desk.spread("events").select("event_id", text(" ", body, "\n").alias("body"))


_PATTERN = config.ARCHIVE_SOURCES["wayback_cnn"]["article_pattern"]
_CDX = """SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS "timestamp",
  'http://www.cnn.com/' || strftime(ts, '%Y/%m/%d') || '/x/' || user_id || '/?utm_source=a&p=' || event_type AS original
 FROM events WHERE event_type <> 'error'"""


@query("cdx_rows", _CDX)
def cdx_rows(desk: Desk):
    return feeds.archive_index_rows(index_answers(desk), F.lit(_PATTERN), keep=("event_id",)).drop("position")


@query("earliest_snapshot", f"""
 SELECT canonical, min("timestamp") AS "timestamp", arg_min(original, "timestamp" || lpad(CAST(event_id AS VARCHAR), 20, '0')) AS original
 FROM (SELECT *, 'https://www.cnn.com/' || split_part(replace(original, 'http://www.cnn.com/', ''), '/?', 1) || '?p=' || split_part(original, '&p=', 2)
   AS canonical FROM ({_CDX})) WHERE original NOT LIKE '%&p=signup' GROUP BY 1""")
def earliest_snapshot(desk: Desk):
    """Addresses of one type are stored already and drop out, whatever their spelling."""
    rows = feeds.archive_index_rows(index_answers(desk), F.lit(_PATTERN), keep=("event_id",))
    known = rows.where(c("original").endswith("p=signup")).select(
        F.regexp_replace("original", "^http://www", "HTTPS://WWW").alias("url"))
    return feeds.earliest_snapshots(rows, known, ["event_id"])
