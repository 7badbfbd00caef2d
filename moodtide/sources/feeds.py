"""Feed bodies to candidate rows: sitemaps, listing APIs and archive indexes.

The bodies are a column of landed documents, so one job reads any number of them. All parsing is done by built-in XML
and JSON functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.functions import dates, text, urls
from moodtide.functions.once import computed_once
from moodtide.session import shared_dir

_ENTRY = "struct<loc:string,`news:news`:struct<`news:title`:string,`news:publication_date`:string>>"
_URLSET = f"struct<url:array<{_ENTRY}>>"
_EITHER = f"struct<url:array<{_ENTRY}>,sitemap:array<struct<loc:string>>>"


def _entry_columns(url: Column) -> list[Column]:
    news = url["news:news"]
    return [text.strip(url["loc"]).alias("url"), text.strip(news["news:title"]).alias("title"),
            dates.parse_iso(news["news:publication_date"], plain_clock=False, date_only=True)
            .cast("timestamp_ntz").alias("published_at")]


def _complete() -> Column:
    return (F.coalesce("url", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != "") & F.col("published_at").isNotNull()


def sitemap_entries(documents: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """News entries of sitemap documents that have address, title and date; ``position`` is their place in the feed."""
    entries = documents.select(*keep, F.posexplode(F.from_xml(body, _URLSET)["url"]).alias("position", "entry"))
    return entries.select(*keep, "position", *_entry_columns(F.col("entry"))).where(_complete())


def month_entries(documents: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Addresses of a month sitemap that belong to a watched section; day from the address, title still unknown."""
    locs = documents.select(*keep, F.posexplode(F.from_xml(body, _URLSET)["url"]).alias("position", "entry"))
    return locs.select(*keep, "position", F.col("entry.loc").alias("url")).where(
        F.col("url").isNotNull() & text.in_section(F.col("url"))).select(
        *keep, "position", "url", F.lit("").alias("title"),
        dates.date_from_url(F.col("url")).cast("timestamp_ntz").alias("published_at"))


def read_sitemap_files(spark: SparkSession, path: str) -> DataFrame:
    """The same entries from XML files; Spark splits large files by ``<url>``."""
    schema = "loc string, `news:news` struct<`news:title`:string,`news:publication_date`:string>"
    rows = spark.read.format("xml").option("rowTag", "url").schema(schema).load(path)
    return rows.select(*_entry_columns(F.struct("loc", F.col("`news:news`")))).where(_complete())


def expand_index(roots: DataFrame, documents: DataFrame) -> DataFrame:
    """Entries of all sitemaps below the given roots, however deep. ``roots`` and ``documents``: url, body.

    An index lists further documents, which are looked up among the landed ones. Each document is parsed once below a root: a level holds only
    addresses that no level above it held, so an index that lists itself ends. Levels are written to the shared folder.
    """
    spark = roots.sparkSession
    folder = shared_dir(spark, "sitemaps")
    level, depth = roots.select(F.col("url").alias("root"), "url", "body"), 0
    while True:
        level.select("root", "url", F.from_xml("body", _EITHER).alias("d")).write.parquet(f"{folder}/{depth}")
        parsed = spark.read.parquet(f"{folder}/{depth}")
        every = spark.read.parquet(*[f"{folder}/{i}" for i in range(depth + 1)])
        children = parsed.select("root", F.explode("d.sitemap").alias("s")).select("root", text.strip(F.col("s.loc")).alias("url")).where("url <> ''")
        fresh = children.distinct().join(every.select("root", "url"), ["root", "url"], "left_anti")
        depth += 1
        level = fresh.join(documents.select("url", "body"), "url").select("root", "url", "body")
        if level.isEmpty():
            break
    entries = every.select("root", F.col("url").alias("sitemap"), F.posexplode("d.url").alias("position", "entry"))
    return entries.select("root", "sitemap", "position", *_entry_columns(F.col("entry"))).where(_complete())


def merge_feeds(news: DataFrame, month: DataFrame) -> DataFrame:
    """One entry per address: the news feed wins over the month feed; inside the news feed the last one counts,
    inside the month feed the first. Both hold position, url, title, published_at."""
    ranked = news.withColumn("rank", F.lit(0)).withColumn("place", -F.col("position")).unionByName(
        month.withColumn("rank", F.lit(1)).withColumn("place", F.col("position")))
    best = ranked.groupBy("url").agg(F.min_by(
        F.struct("title", "published_at", (F.col("rank") == 1).alias("needs_full_fetch")),
        F.struct("rank", "place")).alias("e"))
    return best.select("url", "e.*")


# -- listing APIs ------------------------------------------------------------------------------
_NEWS = ("struct<items:struct<data:array<struct<newsId:bigint,title:string,content:string,summary:string,"
         "author:string,publishAt:bigint>>>>")
_POST = "struct<id:string,title:string,selftext:string,permalink:string,author:string,created_utc:string,score:bigint>"
_LISTING = f"struct<data:struct<children:array<struct<data:{_POST}>>,after:string>>"
_BULK = f"struct<error:string,data:array<{_POST}>>"


def news_items(documents: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    return documents.select(*keep, F.explode(F.from_json(body, _NEWS)["items"]["data"]).alias("item")).select(
        *keep, "item.*")


def forum_posts(documents: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Posts of listing pages."""
    return documents.select(*keep, F.explode(F.from_json(body, _LISTING)["data"]["children"]).alias("c")).select(
        *keep, "c.data.*")


def bulk_posts(documents: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Posts of the bulk API; an answer that carries an error has none."""
    parsed = computed_once(documents, *keep, F.from_json(body, _BULK).alias("p")).where(
        F.coalesce("p.error", F.lit("")) == "")
    return parsed.select(*keep, F.explode("p.data").alias("d")).select(*keep, "d.*")


# -- archive index ------------------------------------------------------------------------------
def archive_index_rows(documents: DataFrame, pattern: Column, body: str = "body",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """Snapshots of an index answer: the first row names the columns; short rows and foreign addresses drop out."""
    table = F.from_json(F.trim(body), "array<array<string>>")
    parsed = computed_once(documents, *keep, pattern.alias("pattern"), table.alias("t")).where("size(t) > 1").select(
        *keep, "pattern", F.get("t", F.lit(0)).alias("header"),
        F.posexplode(F.slice("t", F.lit(2), F.size("t"))).alias("position", "row"))
    cell = lambda name: F.get("row", F.array_position("header", name).cast("int") - 1).alias(name)
    rows = parsed.select(*keep, "position", cell("timestamp"), cell("original"), "pattern")
    return rows.where(F.col("timestamp").isNotNull() & F.rlike("original", F.col("pattern"))).drop("pattern")


def earliest_snapshots(rows: DataFrame, known: DataFrame, order: list[str]) -> DataFrame:
    """Earliest snapshot per canonical address that is not stored yet; a tie keeps the first one seen."""
    first = rows.withColumn("canonical", urls.canonical_url(F.col("original"))).groupBy("canonical").agg(
        F.min_by(F.struct("timestamp", "original"), F.struct("timestamp", *order)).alias("s"))
    seen = known.select(urls.canonical_url(F.col("url")).alias("canonical"))
    return first.join(seen, "canonical", "left_anti").select("canonical", "s.timestamp", "s.original")


def snapshot_address(timestamp: Column, original: Column) -> Column:
    """Where the archive serves the page of a snapshot as it was."""
    return F.concat(F.lit("https://web.archive.org/web/"), timestamp, F.lit("id_/"), original)  # fixed value: the archive's address form


# -- crawl calendar --------------------------------------------------------------------------------
def month_sequence(spans: DataFrame, start: str, end: str) -> DataFrame:
    """Every month from the column ``start`` to the column ``end``, both inclusive."""
    month = F.explode(F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH")))
    return spans.select("*", month.alias("month"))


def rolling_months(day: Column) -> Column:
    """Months whose feed is read on a day: its own, and the one before during the first three days."""
    own = F.date_format(day, "yyyy-MM")
    before = F.date_format(F.add_months(day, -1), "yyyy-MM")
    return F.when(F.dayofmonth(day) <= 3, F.array(own, before)).otherwise(F.array(own))


_PREFIXES = [chr(c) for c in range(ord("a"), ord("z") + 1)] + [str(d) for d in range(10)]


def crawl_slices(years: DataFrame, source: str) -> DataFrame:
    """Index queries of a year: month prefixes of two hosts, or letter prefixes with a date range."""
    year = F.col("year").cast("string")
    if source == "cnn":
        hosts = F.array(F.lit("www.cnn.com"), F.lit("edition.cnn.com"))
        months = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")
        return years.select("year", months).select("year", "month", F.explode(hosts).alias("host")).select(
            F.concat_ws("/", "host", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"),
                        F.lit("")).alias("prefix"),
            F.lit(None).cast("string").alias("from"), F.lit(None).cast("string").alias("to"))
    letters = F.explode(F.array(*[F.lit(p) for p in _PREFIXES])).alias("letter")
    return years.select("year", letters).select(
        F.concat(F.lit("www.wsj.com/articles/"), "letter").alias("prefix"),
        F.concat(year, F.lit("0101")).alias("from"), F.concat(year, F.lit("1231")).alias("to"))


def month_status(fetches: DataFrame) -> DataFrame:
    """A month is done only when none of its fetches failed. ``fetches``: month, error."""
    return fetches.groupBy("month").agg(F.count(F.lit(1)).alias("fetched"), F.count_if("error").alias("errors")).select(
        "month", "fetched", "errors", (F.col("errors") == 0).alias("done"))


def pending_months(months: DataFrame, status: DataFrame) -> DataFrame:
    return months.join(status.where("done").select("month"), "month", "left_anti")
