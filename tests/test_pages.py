"""Parsing jobs on hand-made bodies."""

from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moodtide.functions import html
from moodtide.functions.html import html_to_text, outline_one
from moodtide.plans import repair
from moodtide.operators import quality
from moodtide.sources import domain, feeds, landing, parsers

LONG = "x" * 60


def page(spark, html, source="cnn", job=parsers.news_page, **extra):
    df = spark.createDataFrame([("https://www.cnn.com/2024/02/03/a/?ref=z", html, "20200101000000")],
                               "url string, raw_html string, timestamp string").withColumn("original", F.col("url"))
    args = {parsers.news_page: (df, source), parsers.full_page: (df, source), parsers.archive_page: (df,)}[job]
    return job(*args, **extra).head()


def test_outlines_come_in_runs_of_bounded_size(monkeypatch):
    monkeypatch.setattr(html, "RUN_BYTES", 100)
    bodies = [*["<p>x</p>"] * 50, None, "<p>" + "y" * 500 + "</p>", "", *["<b>z</b>"] * 3]
    runs = list(html.outlines(iter([pa.array(bodies, pa.string()), pa.array([], pa.string())])))
    assert len(runs) > 5 and max(len(r) for r in runs) <= 13
    assert [r for run in runs for r in run.to_pylist()] == pa.array([None if b is None else outline_one(b) for b in bodies], html.OUTLINE_TYPE).to_pylist()


def test_tables_are_spread_by_their_rows(spark, tmp_path, monkeypatch):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(domain, "TASK_ROWS", 20)
    desk = domain.Desk(spark, str(tmp_path))
    assert desk.spread("events").rdd.getNumPartitions() >= 50
    assert sorted(r.id for r in desk.spread("events").collect()) == list(range(1000))


def test_outline_keeps_unclosed_tags_open():
    o = outline_one("<div>a<p>b<p>c</p>d</div>e<br>f<script>var x='</p>'</script>")
    got = {(t["tag"], "".join(o["texts"][t["lo"]:t["hi"]])) for t in o["tags"]}
    assert got == {("div", "abcd"), ("p", "bcd"), ("p", "c"), ("br", ""), ("script", "")}


def test_news_page_order_of_preference(spark):
    html = f"""<html><head><meta property="og:title" content=" Og "><meta name="publishdate" content="2024-02-05 10:11:12">
      <script type="application/ld+json">{{"datePublished":"2020-01-01T00:00:00Z"}}</script></head>
      <h1>Head</h1><div class="x article__content"><p>one</p><p> </p><p>t<b>w</b>o</p></div><article><p>other</p></article></html>"""
    r = page(spark, html)
    assert (r["title"], r["content"], r["published_at"]) == ("Og", "one\ntwo", datetime(2024, 2, 5, 10, 11, 12))
    r = page(spark, html, source="wsj")
    assert r["content"] == "other"
    r = page(spark, "<h1>A <i>b</i></h1><div class='article__content'></div><article><p>fallback</p></article>")
    assert (r["title"], r["content"], r["published_at"]) == ("Ab", "fallback", None)
    r = page(spark, '<script type="application/ld+json">[1]</script><script type="application/ld+json">{"dateCreated":"2024-02-05T01:02:03Z"}</script>')
    assert (r["title"], r["content"], r["published_at"]) == (None, None, datetime(2024, 2, 5, 1, 2, 3))


def test_wsj_data_attribute(spark):
    r = page(spark, '<section data-testid="article-body"><p>in section</p></section>', source="wsj")
    assert r["content"] == "in section"
    r = page(spark, '<div id="js-article__body"><p>by id</p></div>', source="marketwatch")
    assert r["content"] == "by id"


def test_full_page(spark):
    r = page(spark, f"<title>T</title><article><p>{LONG}</p></article><article><p>second</p></article>", job=parsers.full_page)
    assert (r["title"], r["content"], r["published_at"]) == ("T", f"{LONG}\nsecond", None)
    r = page(spark, f"<div class='article__content'><p>{LONG}</p></div>", job=parsers.full_page)
    assert r["title"] == "?ref=z"
    assert page(spark, "<article><p>short</p></article>", job=parsers.full_page) is None


def test_archive_page(spark):
    body = f"<div class='main STORY-text'><p>{LONG}</p><p>{LONG}</p></div>"
    r = page(spark, f"<title>Name - CNN</title>{body}", job=parsers.archive_page)
    assert (r["title"], r["content"], r["url"], r["published_at"]) == (
        "Name", f"{LONG}\n{LONG}", "https://www.cnn.com/2024/02/03/a", datetime(2024, 2, 3))
    r = page(spark, f'<meta name="title" content="M"><time>2024-02-04 01:02:03</time>{body}', job=parsers.archive_page)
    assert (r["title"], r["published_at"]) == ("M", datetime(2024, 2, 4, 1, 2, 3))
    ld = '<script type="application/ld+json">[{"x":1},{"datePublished":"2024-02-05T01:02:03+08:00"}]</script>'
    assert page(spark, f"<h1>H</h1>{ld}{body}", job=parsers.archive_page)["published_at"] == datetime(2024, 2, 5, 1, 2, 3)
    metas = '<meta property="pubdate" content="bad"><meta name="pubdate" content="2021-01-01"><meta name="date" content="2022-01-01">'
    assert page(spark, f"<h1>H</h1>{metas}{body}", job=parsers.archive_page)["published_at"] == datetime(2022, 1, 1)
    assert page(spark, f"<h1>H</h1><p>{LONG}</p>", job=parsers.archive_page) is None
    assert page(spark, body, job=parsers.archive_page) is None


def test_forum_article(spark):
    html = """<div id="main-content"><div class="article-metaline">Author</div>own\n: quote\n引述 x\n<span class="f2">sys</span>
      <div class="push"><span class="push-tag">推 </span><span class="push-userid">bob</span><span class="push-content">: hi</span></div>
      <div class="push"><span class="push-tag">→</span><span class="push-content">: no user</span></div>tail</div>"""
    df = spark.createDataFrame([(1, html), (2, "<div>no main block</div>"), (3, None)], "i int, body string")
    r = parsers.forum_article(df, keep=("i",)).collect()
    assert len(r) == 1 and r[0]["content"] == "own\ntail"
    assert [tuple(x) for x in r[0]["comments"]] == [("bob", "推", ": hi")]


def test_news_and_forum_bodies(spark):
    body = '{"items":{"data":[{"newsId":1,"title":" a ","content":"","summary":"<p>b</p><p>c&amp;d</p>","publishAt":1700000000},' \
           '{"newsId":0,"content":"x","publishAt":1},{"newsId":2,"content":"x"},{"newsId":3,"content":"x","publishAt":1700000000000}]}}'
    items = feeds.news_items(spark.createDataFrame([(body,)], "body string"))
    got = [(r["url"][-1], r["title"], r["content"], r["published_at"]) for r in parsers.news_item(items).orderBy("url").collect()]
    at = datetime(2023, 11, 14, 22, 13, 20)
    assert got == [("1", "a", "b\nc&d", at), ("3", "", "x", at)]
    posts = '{"error":null,"data":[{"id":"a","title":"t","selftext":" [deleted] ","created_utc":"1700000000","score":500,"permalink":"/r/x/"},' \
            '{"id":"b","created_utc":null},{"title":"no id","created_utc":1}]}'
    got = parsers.forum_post(feeds.bulk_posts(spark.createDataFrame([(posts,)], "body string"))).collect()
    assert [(r["content"], r["push_count"], r["url"], r["published_at"]) for r in got] == [("", 100, "https://www.reddit.com/r/x/", at)]
    df = spark.createDataFrame([("<p>a<br/>b</p><!-- c --> d",)], "x string")
    assert df.select(html_to_text(F.col("x"))).head()[0] == "a\nb\n d"


def test_sitemap_files_and_index(spark, tmp_path):
    xml = ('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:news="http://www.google.com/schemas/sitemap-news/0.9">\n'
           '<url><loc>https://x/1</loc><news:news><news:title> A &amp; b </news:title><news:publication_date>2024-01-01T00:00:00+08:00'
           '</news:publication_date></news:news></url>\n<url><loc>https://x/2</loc><news:news><news:title>no date</news:title></news:news></url></urlset>')
    (tmp_path / "a.xml").write_text(xml)
    want = [("https://x/1", "A & b", datetime(2024, 1, 1))]
    assert [tuple(r) for r in feeds.read_sitemap_files(spark, str(tmp_path)).collect()] == want
    docs = spark.createDataFrame([("m1", xml), ("loop", "<sitemapindex><sitemap><loc>loop</loc></sitemap><sitemap><loc>m1</loc></sitemap></sitemapindex>")],
                                 "url string, body string")
    roots = spark.createDataFrame([("r", "<sitemapindex><sitemap><loc> m1 </loc></sitemap><sitemap><loc>gone</loc></sitemap></sitemapindex>")],
                                  "url string, body string")
    got = feeds.expand_index(roots, docs).collect()
    assert [(r["root"], r["sitemap"], r["url"]) for r in got] == [("r", "m1", "https://x/1")]
    # An index that lists itself ends: every document counts once below a root.
    assert feeds.expand_index(docs.where("url = 'loop'"), docs).count() == 1
    # Any depth is followed.
    chain = docs.unionByName(spark.createDataFrame([(f"i{i}", f"<sitemapindex><sitemap><loc>{f'i{i + 1}' if i < 6 else 'm1'}</loc></sitemap></sitemapindex>")
                                                    for i in range(7)], "url string, body string"))
    assert [r["sitemap"] for r in feeds.expand_index(chain.where("url = 'i0'"), chain).collect()] == ["m1"]


def test_archive_index(spark):
    answers = ['[["timestamp","original"],["20200102","https://www.cnn.com/2020/01/02/a"],["20200101"],["20200103","https://other/2020"]]',
               '[["original","timestamp"]]', "", "no json", '[["a","b"],["1","2"]]']
    df = spark.createDataFrame([(a,) for a in answers], "body string")
    pattern = F.lit(r"^https?://(www\.)?cnn\.com/\d{4}/")
    assert [(r["timestamp"], r["original"]) for r in feeds.archive_index_rows(df, pattern).collect()] == [
        ("20200102", "https://www.cnn.com/2020/01/02/a")]


def test_feed_precedence(spark):
    cols = "position int, url string, title string, published_at timestamp_ntz"
    at = datetime(2024, 1, 1)
    news = spark.createDataFrame([(0, "u", "first", at), (1, "u", "last", at)], cols)
    month = spark.createDataFrame([(0, "u", "", at), (1, "m", "", at), (2, "m", "", None)], cols)
    got = {r["url"]: (r["title"], r["published_at"], r["needs_full_fetch"]) for r in feeds.merge_feeds(news, month).collect()}
    assert got == {"u": ("last", at, False), "m": ("", at, True)}


def test_label_answers(spark):
    answers = ['```json\n[{"text_index":0,"sentiment":"Positive","confidence":0.5}]\n```', '[{"text_index":9,"sentiment":"neutral"}]',
               '[{"text_index":"x","sentiment":"neutral"},{"text_index":1,"sentiment":"angry"},{"text_index":1,"sentiment":"negative"}]', "sorry", None]
    df = spark.createDataFrame([(a, [10, 11]) for a in answers], "answer string, ids array<int>")
    got = sorted(tuple(r) for r in parsers.label_response(df, "answer", "ids").collect())
    assert got == [(10, "positive", 0.5), (11, "negative", 0.0)]


def test_responses_keep_the_other_kind_of_body(spark):
    rows = [("s", "u", "2024-01-02", 200, "application/json", "{}"), ("s", "u", "2024-01-01", 200, "text/html", "<p>"),
            ("s", "u", "2024-01-03", 304, None, "<b>")]
    df = spark.createDataFrame(rows, "source string, url string, fetched_at string, http_status int, content_type string, body string")
    r = landing.latest_responses(landing.response_document(df)).head()
    assert (r["raw_html"], r["raw_json"], r["http_status"], r["fetched_at"]) == ("<b>", "{}", 304, "2024-01-03")


def test_repair_and_recheck(spark):
    sources = spark.createDataFrame([(1, "wsj")], "source_id int, source_name string")
    articles = spark.createDataFrame([(1, 1, "u1", None, "kept", None), (2, 1, "u2", "t", "c", datetime(2024, 1, 1))],
                                     "article_id int, source_id int, url string, title string, content string, published_at timestamp_ntz")
    bodies = spark.createDataFrame([("u1", '<meta property="article:published_time" content="2024-01-02T00:00:00Z"><h1>New</h1>', None)],
                                   "url string, raw_html string, raw_json string")
    check = lambda df: quality.run_rules(df, [quality.not_null(1, "articles", c) for c in ("title", "content", "published_at")])
    mended = repair.check_and_repair(articles, sources, bodies, check)
    assert [tuple(r)[3:] for r in mended.orderBy("article_id").collect()] == [
        ("New", "kept", datetime(2024, 1, 2)), ("t", "c", datetime(2024, 1, 1))]
    with pytest.raises(quality.QualityError):
        repair.check_and_repair(articles, sources, bodies.where("url = 'x'"), check)
