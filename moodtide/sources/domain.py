"""Domain tables of a work desk.

``Desk`` gives the domain tables (articles, scores, raw layer, prices …) as lazy DataFrames over a folder of parquet
tables. Times are naive UTC. Nothing is cached and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide import config
from moodtide.session import pin_utc

# Event type -> id of the source whose posts it stands for.
SOURCE_IDS = {"signup": 1, "click": 2, "view": 3, "purchase": 4, "error": 5}
#: Rows of a task that spends long on each row.
TASK_ROWS = 20_000
SOURCE_ROWS = [(1, "ptt"), (2, "cnyes"), (3, "reddit"), (4, "cnn"), (5, "wsj")]


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


class Desk:
    def __init__(self, spark: SparkSession, folder: str):
        pin_utc(spark)
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table for jobs that spend long on each row: when its files make fewer tasks than there are cores, or than its
        rows fill, the rows are dealt out evenly first. A table of many files is read as it lies, without a shuffle."""
        df, stored = self.table(name), Desk.table(self, name)  # a desk of streams reads the same files, but cannot count them
        tasks = max(self.spark.sparkContext.defaultParallelism, -(-stored.count() // TASK_ROWS))  # the count is in the files' footers
        return df.repartition(tasks) if stored.rdd.getNumPartitions() < tasks else df

    # -- reference data ---------------------------------------------------------
    def sources(self) -> DataFrame:
        rows = [(i, n, config.SOURCES[n]["url"], config.SOURCES[n]["has_push_count"]) for i, n in SOURCE_ROWS]
        return config.constant_frame(
            self.spark, rows, "source_id int, source_name string, url string, has_push_count boolean")

    # -- relational layer -------------------------------------------------------
    def articles(self) -> DataFrame:
        kind, value = F.col("event_type"), F.col("value")
        votes = F.least(F.lit(100), F.greatest(F.lit(-100), F.floor(value).cast("int") - 50))
        return self.table("events").select(
            F.col("event_id").alias("article_id"),
            config.lookup(kind, {k: str(v) for k, v in SOURCE_IDS.items()}).cast("int").alias("source_id"),
            F.concat(F.lit("https://news.example.com/a/"), F.col("event_id").cast("string")).alias("url"),
            F.concat(kind, F.lit(" item "), F.col("user_id").cast("string")).alias("title"),
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
            F.col("props").alias("content"),
            F.when(kind.isin("signup", "view"), votes).alias("push_count"),
            F.col("ts").alias("published_at"),
            (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("scraped_at"),
        )

    def scores(self) -> DataFrame:
        """Model scores; posts of little value have none."""
        value = F.col("value")
        return self.table("events").where(value >= 5).select(
            F.col("event_id").alias("article_id"),
            F.round(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), (value - 50) / 50)), 4).alias("score"),
            (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("calculated_at"),
        )

    def comments(self) -> DataFrame:
        """Turns of a conversation as comments; system turns point to an article that does not exist."""
        orphan = F.col("role") == "system"
        return self.table("conversations").select(
            (F.col("conv_id") * 1000 + F.col("turn")).alias("comment_id"),
            F.when(orphan, -1 - F.col("conv_id")).otherwise(F.col("conv_id")).alias("article_id"),
            F.col("role").alias("author"),
            config.lookup(F.col("role"), {"user": "推", "assistant": "→", "system": "噓"}).alias("push_tag"),
            F.col("text").alias("message"),
        )

    # -- raw layer ----------------------------------------------------------------
    def published_text(self) -> Column:
        """Publication time as each source writes it."""
        ts, kind = F.col("ts"), F.col("event_type")
        return (
            F.when(kind == "signup", F.date_format(ts + F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd HH:mm:ss"))
            .when(kind == "click", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
            .when(kind == "view", epoch_seconds(ts).cast("string"))
            .otherwise(F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        )

    def raw_articles(self) -> DataFrame:
        """Append-only deliveries: every post once, posts of high value a second time a day later."""
        events = self.spread("events").withColumn(
            "delivery", F.explode(F.when(F.col("value") > 90, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        again = F.col("delivery") == 2
        kind = F.col("event_type")
        title = F.concat(kind, F.lit(" item "), F.col("user_id").cast("string"), F.when(again, " v2").otherwise(""))
        payload = F.to_json(F.struct(
            F.concat(F.lit("https://news.example.com/a/"), F.col("event_id").cast("string")).alias("url"),
            title.alias("title"),
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
            F.col("props").alias("content"),
            F.when(kind.isin("signup", "view"), F.least(F.lit(100), F.greatest(
                F.lit(-100), F.floor(F.col("value")).cast("int") - 50))).alias("push_count"),
            self.published_text().alias("published_at"),
            F.when(F.col("value") >= 10, F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss"))
            .alias("scraped_at"),
        ), {"ignoreNullFields": "false"})
        names = {k: dict(SOURCE_ROWS)[i] for k, i in SOURCE_IDS.items()}
        return events.select(
            (F.col("event_id") * 2 + F.col("delivery")).alias("raw_id"),
            config.lookup(kind, names).alias("source_name"),
            payload.alias("raw_payload"),
            F.when(again, F.col("ts") + F.expr("INTERVAL 25 HOURS"))
            .otherwise(F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ingested_at"),
        )

    def raw_scores(self) -> DataFrame:
        """Score deliveries; low scores are delivered again with a corrected value."""
        events = self.table("events").where(F.col("value") >= 5).withColumn(
            "delivery", F.explode(F.when(F.col("value") < 15, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        again = F.col("delivery") == 2
        score = F.round(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), (F.col("value") - 50) / 50)), 4)
        corrected = F.round(score / 2, 4)
        url = F.concat(F.lit("https://news.example.com/a/"), F.col("event_id").cast("string"))
        text = F.format_string("%.4f", F.when(again, corrected).otherwise(score))
        return events.select(
            (F.col("event_id") * 2 + F.col("delivery")).alias("raw_id"),
            url.alias("article_id_raw"),
            F.to_json(F.struct(
                text.alias("score"),
                F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss").alias("calculated_at"),
            )).alias("raw_payload"),
            F.when(again, F.col("ts") + F.expr("INTERVAL 26 HOURS"))
            .otherwise(F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("ingested_at"),
        )

    def raw_sources(self) -> DataFrame:
        """The crawler announces its source with every event, in changing spelling."""
        names = {k: dict(SOURCE_ROWS)[i] for k, i in SOURCE_IDS.items()}
        name = config.lookup(F.col("event_type"), names)
        urls = {n: config.SOURCES[n]["url"] for _, n in SOURCE_ROWS}
        spelled = F.when(F.col("value") > 50, F.concat(F.lit(" "), F.upper(name), F.lit(" "))).otherwise(name)
        return self.table("events").select(
            (F.col("event_id") + 1).alias("raw_id"),
            spelled.alias("source_name"),
            F.to_json(F.struct(config.lookup(name, urls).alias("url"))).alias("raw_payload"),
            (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ingested_at"),
        )

    def raw_responses(self) -> DataFrame:
        return self.table("pages").select(
            F.lit("cnn").alias("source"), "url", F.lit(200).alias("http_status"), F.col("html").alias("raw_html"))

    # -- prices and long history ----------------------------------------------------
    def prices(self) -> DataFrame:
        """One close per instrument and weekday, rounded half up in whole cents."""
        orders = self.table("orders").where(F.dayofweek("o_orderdate").between(2, 6))
        symbols = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("0050"), F.lit("VOO"))).otherwise(
            F.array(F.lit("0050")))
        cents = F.rint(F.col("o_totalprice") * 100).cast("bigint")
        per_day = (
            orders.select(F.to_date("o_orderdate").alias("trade_date"), F.explode(symbols).alias("symbol"),
                          cents.alias("cents"))
            .groupBy("symbol", "trade_date").agg(F.sum("cents").alias("total"), F.count(F.lit(1)).alias("n"))
        )
        close = F.expr("(2 * total + 1000 * n) div (2000 * n)")
        return per_day.select("symbol", "trade_date", (close / F.lit(100)).cast("decimal(10,2)").alias("close"))

    def articles_long(self) -> DataFrame:
        """Years of posts: ship date as day, return flag as source."""
        names = {"R": "ptt", "A": "reddit", "N": "cnn"}
        step = F.rint(F.col("l_discount") * 100).cast("int") - 5
        return self.table("lineitem").select(
            F.to_date("l_shipdate").alias("date"),
            config.lookup(F.col("l_returnflag"), names).alias("source_name"),
            F.when(F.col("l_tax") < 0.08, step / F.lit(5.0)).alias("score"),
            F.when(F.col("l_linestatus") == "O", F.col("l_quantity").cast("int")).alias("push_count"),
        )

    # -- texts and labels -------------------------------------------------------------
    def texts(self, spread: bool = True) -> DataFrame:
        """Documents as posts; read as they lie for a job that deals them out itself."""
        return (self.spread("documents") if spread else self.table("documents")).select(
            F.col("doc_id").alias("article_id"), F.element_at(F.split("text", "\n"), 1).alias("title"),
            F.col("text").alias("content"), F.col("source").alias("source_name"), "lang")

    def article_labels(self) -> DataFrame:
        label = (F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral"))
        return self.table("labels").select(
            F.col("doc_id").alias("article_id"), label.alias("label"),
            (F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id"))).cast("timestamp_ntz").alias("labeled_at"))

    # -- operation logs -----------------------------------------------------------------
    def run_log(self) -> DataFrame:
        return self.table("events").select(
            F.col("ts"), F.col("event_type").alias("step"), (F.col("value") / 100).alias("seconds"),
            F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("status"))

    def request_log(self) -> DataFrame:
        return self.table("events").select(
            F.col("ts"), F.col("event_type").alias("endpoint"), (F.col("value") / 100).alias("seconds"))
