"""Landed bodies by content: each body is stored once, and narrow pointers say which one an address had last.

A pointer is a row for an address and a kind of body (HTML or JSON) with time, status and the body's hash. A body that is fetched again unchanged changes its pointer and no
body; what looks for the latest version reads pointers only, and bodies join last, by hash. A later fetch of one kind leaves the other kind's pointer, and an earlier fetch
that lands late changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.sources.keyed import KeyedTable

_POINTERS = "url string, kind string, hash string, source string, http_status int, fetched_at string"


class BodyStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        self.bodies = KeyedTable(spark, f"{path.rstrip('/')}/bodies", ["hash"], buckets, schema="hash string, body string")
        self.pointers = KeyedTable(spark, f"{path.rstrip('/')}/pointers", ["url", "kind"], buckets, schema=_POINTERS)

    def store(self, documents: DataFrame) -> DataFrame:
        """Add fetched documents (source, url, fetched_at, http_status, raw_html, raw_json); the bodies that were new are returned. Bodies go first, so no pointer leads nowhere."""
        kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"raw_{k}").alias("body")) for k in ("html", "json")])
        found = F.filter(kinds, lambda k: k["body"].isNotNull())
        none = F.array(F.struct(F.lit("none").alias("kind"), F.lit(None).cast("string").alias("body")))  # a fetch without a body is a pointer too
        rows = documents.select("source", "url", "fetched_at", F.col("http_status").cast("int").alias("http_status"),
                                F.explode(F.when(F.size(found) > 0, found).otherwise(none)).alias("k"))
        rows = rows.select("source", "url", "fetched_at", "http_status", "k.*", F.sha2("k.body", 256).alias("hash"))
        new = self.bodies.insert_absent(rows.where("body IS NOT NULL").select("hash", "body"), ["hash"])
        fetched = rows.select("url", "kind", "hash", "source", "http_status", "fetched_at")
        if not self.pointers.exists():
            self.pointers.upsert(fetched, ["fetched_at", "hash"])
            return new
        # of the fetches of a batch and the stored one the latest counts: an update that is older than what is stored gives way to it
        stored = self.pointers.known(fetched.select("url", "kind"))
        self.pointers.upsert(fetched.unionByName(stored), ["fetched_at", "hash"])
        return new

    def latest(self) -> DataFrame:
        """``url, source, fetched_at, http_status, html_hash, json_hash`` of every address: narrow rows."""
        at = F.struct("fetched_at", "kind")
        of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("hash"))).alias(f"{kind}_hash")
        return self.pointers.read().groupBy("url").agg(
            F.max_by("source", at).alias("source"), F.max("fetched_at").alias("fetched_at"), F.max_by("http_status", at).alias("http_status"), of("html"), of("json"))

    def documents(self, urls: DataFrame | None = None) -> DataFrame:
        """Latest documents (url, source, fetched_at, http_status, raw_html, raw_json), of some addresses or of all. For some, only units of bodies are read that hold theirs."""
        rows = self.latest()
        if urls is not None:
            rows = rows.join(urls.select("url").distinct(), "url", "left_semi")
        wanted = rows.select(F.explode(F.array("html_hash", "json_hash")).alias("hash")).where("hash IS NOT NULL")
        bodies = self.bodies.read() if urls is None else self.bodies.known(wanted)
        for kind in ("html", "json"):
            rows = rows.join(bodies.select(F.col("hash").alias(f"{kind}_hash"), F.col("body").alias(f"raw_{kind}")), f"{kind}_hash", "left")
        return rows.select("url", "source", "fetched_at", "http_status", "raw_html", "raw_json")
