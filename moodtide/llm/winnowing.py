"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every window of consecutive k-gram hashes the least is kept (all of equal least ones), in documents and test items alike. A shared span as long as a window holds
the same hashes on both sides, so both keep the same one: no shared span of ``window`` words is missed. Kept hashes are joined, and each hit is extended word by word
to both sides, at most to the ends of the windows it can stand for; where the extended span is a window long, its words are hit. Items shorter than ``window`` are one
window each; for every such length that the items have, fingerprints of that length are kept as well.

The first pass writes narrow fingerprints; texts are read again only for documents with a hit. The items' fingerprints are broadcast up to ``MOST_BROADCAST`` rows; beyond
that both sides are shuffled, with common fingerprints dealt to ``SALTS`` tasks.

Defined cases: a null text has no words; rows that repeat an id are judged one by one, rows that repeat the text too share their result; null ids of items are read as
empty; items that repeat an id are one item; without items no word is hit; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.simhash import text_mark
from moodtide.session import shared_dir

WINDOW = 10
MOST_BROADCAST = 200_000
SALTS = 16
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: str) -> Column:
    """Words of a text column with A-Z lowered; no empty ones."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), _CAPITALS, _CAPITALS.lower())
    return F.filter(F.split(lowered, _BETWEEN), lambda w: w != "")


def gram(length: int) -> int:
    """Words of the k-grams whose least hash stands for windows of ``length`` words."""
    return (length + 1) // 2


def _with_kept(rows: DataFrame, length: int) -> DataFrame:
    """``rows`` with ``_kept_<length>_``, ``array<struct<length, at, h>>``: the winnowed k-grams of column ``words`` for windows of ``length`` words."""
    k = gram(length)
    wide = length - k + 1
    n = F.size("words")
    hashes = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(F.lit(length), *[F.get("words", i + j) for j in range(k)]))
    least = F.transform(F.sequence(F.lit(0), n - length), lambda i: _pick(F.least, [F.get("_hashes_", i + j) for j in range(wide)]))
    rows = rows.withColumn("_hashes_", F.when(n >= length, hashes)).withColumn("_least_", F.when(n >= length, least))
    # a hash is the least of some window if it equals the greatest of the least ones of all windows that hold it
    here = lambda h, i: F.when(h == _pick(F.greatest, [F.get("_least_", i - j) for j in range(wide)]), h)
    marked = F.transform("_hashes_", lambda h, i: F.struct(F.lit(length).alias("length"), i.alias("at"), here(h, i).alias("h")))
    return rows.withColumn(f"_kept_{length}_", F.coalesce(F.filter(marked, lambda m: m["h"].isNotNull()), F.array())).drop("_hashes_", "_least_")


def _pick(of, values: list[Column]) -> Column:
    return of(*values) if len(values) > 1 else values[0]


def fingerprints(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """``rows`` with their column ``words`` and ``kept``: the winnowed k-grams for each of the window lengths."""
    for length in lengths:
        rows = _with_kept(rows, length)
    return rows.withColumn("kept", F.concat(*[F.col(f"_kept_{n}_") for n in lengths])).drop(*[f"_kept_{n}_" for n in lengths])


def _around(length: Column, at: Column) -> tuple[Column, Column, Column]:
    """Words before a k-gram (nearest first), in it, and behind it, as far as a window that holds it can reach."""
    k = F.floor((length + 1) / 2).cast("int")
    reach = length - k
    before = F.reverse(F.slice("words", F.greatest(F.lit(1), at - reach + 1), F.least(at, reach)))
    return before.alias("before"), F.slice("words", at + 1, k).alias("gram"), F.slice("words", at + k + 1, reach).alias("behind")


def _alike(a: str, b: str) -> Column:
    """How many leading words of two columns are the same."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, most_broadcast: int = MOST_BROADCAST,
                  doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items``: for each row of ``docs``, its words inside windows of items, and these items."""
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession, "winnowing")
    tests = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(text).alias("words")).filter(F.size("words") > 0)
    tests = tests.withColumn("length", F.least(F.size("words"), F.lit(window)))
    lengths = sorted(r[0] for r in tests.select("length").distinct().collect()) or [window]  # at most ``window`` numbers
    tests = fingerprints(tests, lengths).withColumn("kept", F.explode(F.filter("kept", lambda m: m["length"] == F.col("length"))))
    tests.select("item", "kept.*", *_around(F.col("kept.length"), F.col("kept.at"))).drop("at").distinct().write.parquet(f"{folder}/items")
    tests = spark.read.parquet(f"{folder}/items")
    few = tests.count() <= most_broadcast

    def meet(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        """Join on (length, h). Any fingerprint may be common on the left: beyond a broadcast it is dealt to several tasks."""
        if few:
            return left.join(F.broadcast(right), ["length", "h"], how)
        salted = left.withColumn("salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int"))
        return salted.join(right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["length", "h", "salt"], how).drop("salt")

    rows = docs.select(F.col(doc_id).alias("doc_id"), text_mark(text).alias("mark"), words(text).alias("words"))
    told = fingerprints(rows, lengths).select("doc_id", "mark", F.size("words").cast("bigint").alias("n_words"), "kept")
    told.write.parquet(f"{folder}/documents")
    told = spark.read.parquet(f"{folder}/documents")
    seeds = meet(told.select("doc_id", "mark", F.explode("kept").alias("k")).select("doc_id", "mark", "k.*"), tests.select("length", "h").distinct(), "left_semi")
    seeds.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("length", "at", "h")).alias("seeds")).write.parquet(f"{folder}/seeds")
    seeds = spark.read.parquet(f"{folder}/seeds").withColumnsRenamed({"doc_id": "id", "mark": "own"})
    keyed = docs.select(F.col(doc_id).alias("doc_id"), text_mark(text).alias("mark"), F.col(text).alias("text"))
    # one plan at all sizes: the texts' rows are sorted to meet their seeds, and Spark's own runtime filter cuts them down first where the table is large
    texts = keyed.join(seeds.hint("merge"), keyed["doc_id"].eqNullSafe(seeds["id"]) & (keyed["mark"] == seeds["own"])).select("doc_id", "mark", words("text").alias("words"), "seeds")
    near = F.transform("seeds", lambda s: F.struct(s["length"].alias("length"), s["at"].alias("at"), s["h"].alias("h"), *_around(s["length"], s["at"])))
    hits = texts.select("doc_id", "mark", F.explode(near).alias("s")).select("doc_id", "mark", "s.*")
    other = tests.withColumnsRenamed({c: f"{c}_" for c in ("before", "gram", "behind")})
    met = meet(hits, other, "inner").filter(F.col("gram") == F.col("gram_"))
    met = met.select("doc_id", "mark", "item", "length", "at", F.size("gram").alias("k"), _alike("before", "before_").alias("l"), _alike("behind", "behind_").alias("r"))
    met = met.filter(F.col("l") + F.col("k") + F.col("r") >= F.col("length"))
    spans = met.groupBy("doc_id", "mark").agg(
        F.sort_array(F.collect_set(F.struct((F.col("at") - F.col("l")).alias("a"), (F.col("at") + F.col("k") + F.col("r")).alias("b")))).alias("spans"),
        F.sort_array(F.collect_set("item")).alias("items"))
    union = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum")), lambda s, x: F.struct(
        F.greatest(s["end"], x["b"]).alias("end"), (s["sum"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["end"], x["a"]))).alias("sum")), lambda s: s["sum"])
    spans.select(F.col("doc_id").alias("id"), F.col("mark").alias("own"), union.cast("bigint").alias("n_hit"), "items").write.parquet(f"{folder}/spans")
    spans = spark.read.parquet(f"{folder}/spans")
    rows = told.select("doc_id", "mark", "n_words").join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("own")), "left")
    found = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(found).cast("bigint").alias("n_items"), F.sha2(F.array_join(found, ","), 256).alias("items_sha256"),
                       (n_hit > 0).alias("contaminated"), found.alias("items"))
