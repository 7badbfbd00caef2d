"""The tables of a deployment as folders below one root."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.operators.merge import write_version
from moodtide.sources.bodies import BodyStore
from moodtide.sources.keyed import KeyedTable

_MEASURES = "avg_sentiment decimal({},4), avg_push_count decimal(8,2)"
#: Tables that merges change: key, the column that numbers rows, columns.
KEYED = {
    "articles": (["url"], "article_id", "article_id bigint, source_id int, title string, push_count bigint, author string, url string, content string, "
                                        "published_at timestamp_ntz, scraped_at timestamp_ntz"),
    "comments": (["article_id", "place"], "article_id", "article_id bigint, place int, author string, push_tag string, message string"),
    "sentiment_scores": (["article_id"], None, "article_id bigint, score double, calculated_at timestamp_ntz"),
    "prices": (["symbol", "trade_date"], None, "symbol string, trade_date date, close decimal(10,2), change decimal(10,2)"),
    "fact_sentiment": (["fact_date", "source_id"], None, "fact_date date, source_id int, stock_symbol string, source_name string, article_count bigint, "
                                                         f"scored_articles bigint, {_MEASURES.format(6)}"),
    "mart_daily_summary": (["summary_date", "source_name"], None, "summary_date date, source_name string, total_articles bigint, scored_articles bigint, " + _MEASURES.format(6)),
    "mart_market_summary": (["fact_date", "market_code"], None, "fact_date date, market_code string, source_count bigint, total_articles bigint, scored_articles bigint, "
                                                                + _MEASURES.format(5)),
}


class Lake:
    """Append-only tables, versioned tables, and tables by key.

    A versioned table is replaced by writing a new version beside the old one and then noting its number, so a job may
    read the table it is about to replace, and a lost job leaves the old version in place. An empty version counts too.
    The tables of ``KEYED`` are merged by key, a few files at a time; replacing one writes what differs.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def table(self, name: str) -> KeyedTable:
        keys, counter, schema = KEYED[name]
        return KeyedTable(self.spark, self.path(name), keys, self.buckets, counter, schema)

    def bodies(self) -> BodyStore:
        return BodyStore(self.spark, self.path("raw_responses"), self.buckets)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _is_table(self, path: str) -> bool:
        try:
            self.spark.read.parquet(path)
            return True
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    def exists(self, name: str) -> bool:
        if name in KEYED:
            return self.table(name).exists()
        return self._newest(name) > 0 or self._is_table(self.path(name))

    def _newest(self, name: str) -> int:
        """Number of the current version, 0 for a table without versions; one note per version is read."""
        notes = self.path(f"versions/{name}")
        return self.spark.read.parquet(notes).agg(F.max("version")).head()[0] if self._is_table(notes) else 0

    def read(self, name: str) -> DataFrame:
        """Current content of a table."""
        if name in KEYED:
            return self.table(name).read()
        version = self._newest(name)
        return self.spark.read.parquet(f"{self.path(name)}/version={version}" if version else self.path(name))

    def replace(self, name: str, df: DataFrame) -> None:
        if name in KEYED:
            return self.table(name).sync(df)
        version = self._newest(name) + 1
        write_version(df, self.path(name), str(version))
        self.spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(self.path(f"versions/{name}"))

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path(name))
