"""A whole run over landed bodies of all sources, twice."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from moodtide.operators import monitoring
from moodtide.operators.numbering import ranked
from moodtide.plans import daily_run, ingest, warehouse
from moodtide.sources.keyed import KeyedTable
from moodtide.sources.lake import KEYED, Lake

NOW = datetime(2024, 6, 1)
TEXT = "words " * 30
NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:news="http://www.google.com/schemas/sitemap-news/0.9"'


def sitemap(loc, title):
    return (f"<urlset {NS}><url><loc>{loc}</loc><news:news><news:title>{title}</news:title>"
            "<news:publication_date>2024-02-05T10:00:00Z</news:publication_date></news:news></url></urlset>")


BODIES = [
    ("ptt", "list", "https://www.ptt.cc/bbs/Stock/index.html",
     '<div class="r-ent"><div class="nrec">爆</div><div class="title"><a href="/bbs/Stock/M.1700000000.A.1.html">[標的] x</a></div>'
     '<div class="author">bob</div></div><div class="r-ent"><div class="title"><a href="/bbs/Stock/M.1700000001.A.1.html">no page</a></div></div>'),
    ("ptt", "post", "https://www.ptt.cc/bbs/Stock/M.1700000000.A.1.html",
     '<div id="main-content">own text<div class="push"><span class="push-tag">推</span><span class="push-userid">amy</span>'
     '<span class="push-content">: yes</span></div></div>'),
    ("cnyes", "listing", "https://api/1", '{"items":{"data":[{"newsId":5,"title":"t","content":"<p>news</p>","publishAt":1700000000}]}}'),
    ("reddit", "listing", "https://api/2", '{"data":{"children":[{"data":{"id":"a","title":"r","selftext":"b","permalink":"/r/stocks/comments/a/x/",'
                                           '"author":"joe","created_utc":1700000000.0,"score":250}}]}}'),
    ("reddit", "bulk", "https://api/3", '{"data":[{"id":"a","title":"r","selftext":"b","permalink":"/r/stocks/comments/a/x/",'
                                        '"author":"joe","created_utc":1700000000,"score":250}]}'),
    ("wsj", "sitemap", "https://wsj/s.xml", sitemap("https://www.wsj.com/articles/a", "Wsj title")),
    ("wsj", "page", "https://www.wsj.com/articles/a", f'<div class="article-content"><p>{TEXT}</p></div>'),
    ("marketwatch", "sitemap", "https://mw/s.xml", sitemap("https://www.marketwatch.com/story/a", "Mw title")),
    ("cnn", "sitemap", "https://cnn/news.xml", sitemap("https://edition.cnn.com/2024/02/05/business/a", "Cnn title")),
    ("cnn", "month", "https://cnn/2024/02.xml", f"<urlset {NS}><url><loc>https://edition.cnn.com/2024/02/05/business/a</loc></url>"
                                                "<url><loc>https://edition.cnn.com/2024/02/04/tech/b</loc></url>"
                                                "<url><loc>https://edition.cnn.com/2024/02/04/sport/c</loc></url></urlset>"),
    ("cnn", "page", "https://edition.cnn.com/2024/02/04/tech/b", f"<title>Full</title><article><p>{TEXT}</p></article>"),
]
INDEX = ('<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><sitemap><loc>https://mw/inner.xml</loc></sitemap>'
         "<sitemap><loc>https://mw/index.xml</loc></sitemap></sitemapindex>")
CDX = '[["urlkey","timestamp","original"],["k","{0}","{1}"],["k","{2}","{1}?utm_source=x"],["k","20200101000000","https://elsewhere.example/"]]'
SNAPSHOT = f"<html><h1>Old</h1><article><p>{TEXT}</p></article></html>"
OLD = [
    ("marketwatch", "index", "https://mw/index.xml", INDEX), ("marketwatch", "sitemap", "https://mw/inner.xml", sitemap("https://www.marketwatch.com/story/inner", "Inner")),
    ("wayback_cnn", "cdx", "https://cdx/1", CDX.format("20150102000000", "https://www.cnn.com/2015/01/01/x", "20150105000000")),
    ("wayback_cnn", "page", "https://web.archive.org/web/20150102000000id_/https://www.cnn.com/2015/01/01/x", SNAPSHOT),
    ("wayback_cnn", "page", "https://web.archive.org/web/20150105000000id_/https://www.cnn.com/2015/01/01/x?utm_source=x", SNAPSHOT.replace("Old", "Later")),
    ("wayback_wsj", "cdx", "https://cdx/2", CDX.format("20160102000000", "https://www.wsj.com/articles/old", "20160105000000")),
    ("wayback_wsj", "page", "https://web.archive.org/web/20160102000000id_/https://www.wsj.com/articles/old", SNAPSHOT),
    ("wayback_wsj", "cdx", "https://cdx/3", CDX.format("20170102000000", "https://www.wsj.com/articles/no-page", "20170105000000")),
    ("wsj", "rss", "https://wsj/feed", "<rss/>"), ("wsj", "rss", "https://wsj/feed2", "<rss/>"),
]


def as_landed(spark, bodies):
    rows = [(s, k, u, "2024-06-01T00:00:00", 200, "application/json" if b.startswith(("{", "[")) else "text/html", b) for s, k, u, b in bodies]
    return spark.createDataFrame(rows, "source string, kind string, url string, fetched_at string, http_status int, "
                                       "content_type string, body string")


def one_score(df):
    return df.withColumn("probs", F.array(F.lit(0.1), F.lit(0.2), F.lit(0.7)))


def content(lake):
    """What a run leaves, without its times."""
    names = ("articles", "comments", "sentiment_scores", "fact_sentiment", "mart_daily_summary", "mart_market_summary")
    return {n: sorted(map(str, lake.read(n).drop("calculated_at", "scraped_at").collect())) for n in names}


def units(table):
    return {(r.bucket, r.folder) for r in table.manifest().units}


@pytest.fixture(scope="module")
def landed(spark):
    return as_landed(spark, BODIES)


def add_prices(spark, lake):
    rows = [(s, date(2023, 11, 14) + timedelta(days=i), 10.0 + i, 1.0 if i else None) for s in ("0050", "VOO") for i in range(5)]
    lake.replace("prices", spark.createDataFrame(rows, "symbol string, trade_date date, c double, d double").select(
        "symbol", "trade_date", F.col("c").cast("decimal(10,2)").alias("close"), F.col("d").cast("decimal(10,2)").alias("change")))


def test_run_twice(spark, landed, tmp_path):
    lake = Lake(spark, str(tmp_path), buckets=4)
    steps = daily_run.lake_steps(lake, landed, NOW, one_score)
    steps.pop("predict")  # five days of prices are no basis for a forecast; the gate has its own check
    add_prices(spark, lake)

    assert {r.status for r in daily_run.run_logged(lake, steps)} == {"success"}
    first = {r["url"]: r for r in lake.read("articles").collect()}
    assert len(first) == 7 and {r["article_id"] for r in first.values()} == set(range(1, 8))
    post = first["https://www.ptt.cc/bbs/Stock/M.1700000000.A.1.html"]
    assert (post["push_count"], post["content"], len(post["author"])) == (100, "own text", 16)
    assert first["https://www.wsj.com/articles/a"]["content"] == TEXT.strip()
    assert first["https://www.marketwatch.com/story/a"]["content"] == "Mw title"
    assert first["https://edition.cnn.com/2024/02/05/business/a"]["title"] == "Cnn title"
    full = first["https://edition.cnn.com/2024/02/04/tech/b"]
    assert (full["title"], full["published_at"]) == ("Full", datetime(2024, 2, 4))
    assert [(r["article_id"], r["push_tag"], r["message"]) for r in lake.read("comments").collect()] == [(post["article_id"], "推", ": yes")]
    assert {round(r["score"], 6) for r in lake.read("sentiment_scores").collect()} == {0.6}
    assert lake.read("mart_market_summary").agg(F.sum("total_articles")).head()[0] == 7

    before = {n: units(lake.table(n)) for n in KEYED}
    # the next run brings one new article and all bodies again
    more = BODIES + [("wsj", "sitemap", "https://wsj/t.xml", sitemap("https://www.wsj.com/articles/new", "New title"))]
    again = daily_run.lake_steps(lake, as_landed(spark, more), NOW + timedelta(hours=1), one_score)
    again.pop("predict")
    daily_run.run_logged(lake, again)
    second = {r["url"]: r for r in lake.read("articles").collect()}
    assert {u: r for u, r in second.items() if u in first} == first and len(second) == 8 and lake.read("comments").count() == 1
    added = units(lake.table("articles")) - before["articles"]
    assert len(added) == 1 and before["articles"] <= units(lake.table("articles"))  # one unit more, all others as they were
    assert spark.read.parquet(lake.path(f"articles/data/{min(added)[1]}")).count() == 1
    assert len(units(lake.table("sentiment_scores")) - before["sentiment_scores"]) == 1 and units(lake.table("comments")) == before["comments"]
    assert len(units(lake.table("fact_sentiment")) - before["fact_sentiment"]) == 1  # the day and source of the new article
    assert lake.bodies().bodies.read().count() == len({b for *_, b in more})
    assert spark.read.parquet(lake.path("raw_articles")).count() == 17  # append-only: every delivery, the post of both APIs twice
    fact = warehouse.fact_sentiment(lake.read("articles"), lake.read("sentiment_scores"), lake.read("sources"), lake.read("dim_source"))
    assert sorted(map(str, lake.read("fact_sentiment").collect())) == sorted(map(str, fact.collect()))
    # the second snapshot holds copies of the new units only, and each gives the table of its time
    times = [t.strftime("%Y%m%d%H%M%S") for t in (NOW, NOW + timedelta(hours=1))]
    saved = lake.table("articles")
    place = lake.path("backup/articles")
    assert [saved.restored(place, t).count() for t in times] == [7, 8]
    assert spark.read.parquet(f"{place}/units={times[1]}").count() == 1 and saved.snapshot(place, "later") == 0
    # the log of both runs, as monitoring reads it
    log = lake.read("run_log")
    assert {r["step"] for r in monitoring.step_times(log).collect()} == set(again) and monitoring.failure_ratio(log).head()["failures"] == 0


@pytest.mark.parametrize("where", ["extract", "dw_etl"])
def test_a_run_that_is_lost_in_a_step_ends_like_a_clean_one(spark, tmp_path, monkeypatch, where):
    """The manifest of some table cannot be written in the middle of the step; the next run goes on from there."""
    bodies = [b for b in BODIES if b[0] in ("ptt", "reddit")]
    if "clean" not in CLEAN:
        lake = Lake(spark, str(tmp_path / "clean"), buckets=1)
        steps = daily_run.lake_steps(lake, as_landed(spark, bodies), NOW, one_score)
        add_prices(spark, lake)
        daily_run.run({n: steps[n] for n in ("schema", "extract", "score", "dw_etl")})
        CLEAN["clean"] = content(lake)
    lake = Lake(spark, str(tmp_path / "lost"), buckets=1)
    add_prices(spark, lake)
    for attempt in range(2):
        steps = daily_run.lake_steps(lake, as_landed(spark, bodies), NOW + timedelta(hours=attempt), one_score)
        if attempt == 0:
            step, commit = steps[where], KeyedTable._commit
            last = {"extract": "articles", "dw_etl": "totals"}[where]

            def lost(self, *args, last=last, commit=commit):
                if self.path.endswith(last):
                    raise RuntimeError("lost")
                commit(self, *args)

            def breaking(step=step):
                with monkeypatch.context() as m:
                    m.setattr(KeyedTable, "_commit", lost)
                    step()
                    raise RuntimeError("lost")

            steps = {n: breaking if n == where else f for n, f in steps.items()}
            order = ("schema", "extract", "score", "dw_etl")
            for n in order[:order.index(where)]:
                steps[n]()
            with pytest.raises(RuntimeError, match="lost"):
                steps[where]()
        else:
            daily_run.run({n: steps[n] for n in ("schema", "extract", "score", "dw_etl")})
    assert content(lake) == CLEAN["clean"]


CLEAN: dict = {}


def test_all_sources_land_and_what_is_not_read_is_told(spark, tmp_path):
    landed = as_landed(spark, OLD)
    found = {r["url"]: r for r in ingest.scraped(landed, F.lit(NOW)).collect()}
    assert {u: (r["source_name"], r["title"], str(r["published_at"])) for u, r in found.items()} == {
        "https://www.marketwatch.com/story/inner": ("marketwatch", "Inner", "2024-02-05 10:00:00"),
        "https://www.cnn.com/2015/01/01/x": ("wayback_cnn", "Old", "2015-01-01 00:00:00"),
        "https://www.wsj.com/articles/old": ("wayback_wsj", "Old", "2016-01-02 00:00:00")}
    assert [tuple(r) for r in ingest.unread(landed).collect()] == [("wsj", "rss", 2)]


def test_rejected_rows_are_kept_with_their_reasons(spark, landed, tmp_path):
    rows = ingest.routed(landed, F.lit(datetime(2024, 2, 5)))
    valid, seen = ingest.quarantine(rows, str(tmp_path / "q"))
    kept = ingest.rejected(spark, str(tmp_path / "q"), rows.schema).collect()
    assert {r["url"] for r in kept} == {"https://www.wsj.com/articles/a", "https://www.marketwatch.com/story/a", "https://edition.cnn.com/2024/02/05/business/a"}
    assert all(r["reasons"] == ["published_at"] for r in kept)
    assert (seen["valid"], seen["rejected"], seen["published_at"], seen["title"]) == (valid.count(), 3, 3, 0)


def test_price_load(spark, tmp_path):
    table = Lake(spark, str(tmp_path), buckets=1).table("prices")
    day = lambda i, close: ("VOO", date(2024, 1, i), close)
    load = lambda rows: daily_run.load_prices(table, spark.createDataFrame(rows, "symbol string, trade_date date, close double"))
    table.create()
    load([day(2, 10.0), day(3, 11.5)])
    load([day(3, 11.0), day(4, 10.5)])
    assert [(r["trade_date"].day, float(r["close"]), r["change"] and float(r["change"])) for r in table.read().orderBy("trade_date").collect()] == [
        (2, 10.0, None), (3, 11.0, 1.0), (4, 10.5, -0.5)]


def test_prediction_step(spark, landed, tmp_path):
    """Half a year of posts and prices: one fold per market, one history row each; without prices nothing is predicted."""
    lake = Lake(spark, str(tmp_path), buckets=1)
    steps = daily_run.lake_steps(lake, landed, NOW)
    steps["schema"]()
    days = spark.range(180).select("id", F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    posts = days.select(F.explode(F.array(F.struct(F.col("id").alias("article_id"), F.lit(1).alias("source_id"), "day"),
                                          F.struct((F.col("id") + 1000).alias("article_id"), F.lit(4).alias("source_id"), "day"))).alias("x"))
    none = F.lit(None).cast("string")
    at = F.col("x.day").cast("timestamp_ntz")
    lake.replace("articles", posts.select("x.article_id", "x.source_id", F.lit("t").alias("title"), F.lit(1).cast("long").alias("push_count"), none.alias("author"),
                                          F.concat(F.lit("https://x/"), F.col("x.article_id").cast("string")).alias("url"), none.alias("content"), at.alias("published_at"), at.alias("scraped_at")))
    lake.replace("sentiment_scores", lake.read("articles").select("article_id", F.sin(F.col("article_id").cast("double")).alias("score"), F.col("published_at").alias("calculated_at")))
    steps["predict"]()
    assert lake.read("prediction_runs").count() == 0
    price = days.select(F.explode(F.array(F.lit("0050"), F.lit("VOO"))).alias("symbol"), F.col("day").alias("trade_date"),
                        (F.sin(F.col("id") / 3.0) + 10).cast("decimal(10,2)").alias("close"), F.lit(None).cast("decimal(10,2)").alias("change"))
    lake.replace("prices", price)
    steps["predict"]()
    runs = {r["market"]: r for r in lake.read("prediction_runs").collect()}
    assert set(runs) == {"TW", "US"} and all(80 <= r["sample_days"] <= 92 and 0 <= r["accuracy"] <= 1 for r in runs.values())
    assert runs["TW"]["run_at"] == NOW


def test_missing_bodies_abort_the_run(spark, landed, tmp_path):
    lake = Lake(spark, str(tmp_path), buckets=1)
    steps = daily_run.lake_steps(lake, landed, NOW)
    with pytest.raises(daily_run.RunAborted, match="stock_prices"):
        daily_run.run({k: steps[k] for k in ("schema", "extract", "transform", "dw_etl")})


def test_rejected_articles_are_not_stored(landed):
    future = ingest.scraped(landed, F.lit(datetime(2023, 12, 1)))
    assert {r["source_name"] for r in future.collect()} == {"ptt", "cnyes", "reddit"}


def test_numbers_are_dense(spark):
    df = spark.range(10000)
    got = ranked(df, [], F.sha2(F.col("id").cast("string"), 256), "n", "of").agg(
        F.min("n"), F.max("n"), F.countDistinct("n"), F.max("of")).head()
    assert tuple(got) == (1, 10000, 10000, 10000)
