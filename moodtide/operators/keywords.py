"""Keyword ranking by TF-IDF over 1- and 2-word terms."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.session import shared_dir

# --- fixed values ---------------------------------------------------------------
WORD = r"[\p{L}\p{N}_]{2,}"
MAX_TERMS, TOP_TERMS, MAX_DOCS = 2000, 20, 200
# --------------------------------------------------------------------------------
#: Characters of the texts of a block, and of those whose terms a bucket counts, about.
BLOCK_CHARS, BUCKET_CHARS = 8 << 20, 16 << 20
#: Most frequent terms whose scores are added up first.
FIRST_TERMS = 1 << 16

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ASKED = "block int, bucket int, n int, terms binary, docs binary"
_TOLD = "block int, bucket int, n int, df binary"


def top_keywords(docs: DataFrame, doc_id: str, text: str, top: int = TOP_TERMS, max_terms: int | None = None) -> DataFrame:
    """Terms with the largest sum of their length-normalised weights; idf = ln((1 + n) / (1 + df)) + 1.

    The vocabulary is all terms, or with ``max_terms`` that many of the most frequent ones (ties by term).
    """
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    if max_terms is not None:
        scores = _of_most(docs, _words(rows).select("doc", _terms().alias("terms")), max_terms)
    else:
        scores = _of_all(rows, top)
        rounded = F.round("score", 9)
        least = scores.select(rounded.alias("r")).orderBy(F.desc("r")).limit(top).agg(F.min("r")).scalar()
        best = scores.where(rounded >= least)  # the first ones and what ties with the last
        held_by = best.select("doc").distinct()
        held_by = F.broadcast(held_by) if best.count() <= FIRST_TERMS else held_by
        found = _words(rows.join(held_by, "doc", "left_semi")).select(F.inline(F.arrays_zip(_hashes().alias("h"), _terms().alias("term"))))
        scores = best.join(found.distinct(), "h").select("term", "score")
    return (scores.orderBy(F.desc(F.round("score", 9)), F.desc("term")).limit(top)
            .select(F.col("term").alias("Word"), F.round("score", 3).alias("Score")))


def _words(rows: DataFrame) -> DataFrame:
    """The rows with the words of their text in its place, which are looked for once; the other columns stay what rows are dealt by."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))
    return rows.select(*[c for c in rows.columns if c != "text"], F.inline(F.array(F.struct(words.alias("w")))))


def _pairs(of: Callable[[Column, Column], Column], kind: str) -> Column:
    return F.when(F.size("w") > 1, F.transform(
        F.sequence(F.lit(1), F.size("w") - 1),
        lambda i: of(F.get("w", i - 1), F.get("w", i)))).otherwise(
        F.array().cast(f"array<{kind}>"))


def _terms() -> Column:
    return F.concat("w", _pairs(lambda a, b: F.concat_ws(" ", a, b), "string"))


def _hashes() -> Column:
    """Hashes of the terms, in their order."""
    return F.concat(F.transform("w", lambda w: F.xxhash64(w)), _pairs(lambda a, b: F.xxhash64(a, b), "bigint"))


def _of_most(docs: DataFrame, terms: DataFrame, max_terms: int) -> DataFrame:
    """``term, score`` over a vocabulary that is small. Terms are counted by document once and written."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "terms")
    terms.select("doc", F.explode("terms").alias("term")).groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf")).write.parquet(folder)
    tf = spark.read.parquet(folder)
    found_in = tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df")).orderBy(F.desc("total"), "term").limit(max_terms)
    n = docs.agg(F.count(F.lit(1))).scalar()
    idf = F.log((1 + n) / (1 + F.col("df"))) + 1
    weighted = tf.join(found_in.drop("total"), "term").select("doc", "term", (F.col("tf") * idf).alias("x"))
    norm = weighted.groupBy("doc").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return weighted.join(norm, "doc").groupBy("term").agg(F.sum(F.col("x") / F.col("norm")).alias("score"))


def _of_all(rows: DataFrame, top: int) -> DataFrame:
    """``h, score, doc`` of terms, told apart by their 64-bit hash, each with a document that has it: the ``top`` best of all terms, what ties with them, and more.

    Texts are dealt by id into blocks, so rows of one id meet. Nothing is kept of a text: it is dealt and read once to count, and once to score. A block asks buckets of
    hashes for its different terms, and a bucket answers with the numbers of documents in the order of the question. A document adds at most 1 to the score of a
    term, so terms in fewer documents than the last of the best scores cannot be among these, and their sums are left out.
    """
    spark = rows.sparkSession
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    n, (blocks, buckets) = size.n, (max(2 * spark.sparkContext.defaultParallelism, -(-(size.chars or 0) // chars)) for chars in (BLOCK_CHARS, BUCKET_CHARS))
    parts = max(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc"), F.lit(blocks)).cast("int")).repartition(parts, "block")
    hashed = _words(dealt).select("block", "doc", _hashes().alias("hashes")).groupBy("block")
    doc = rows.schema["doc"].dataType.simpleString()

    def ask(table: pa.Table) -> pa.Table:
        terms, begins, row, *_ = _counted(table)
        held = np.diff(begins, append=len(row)).astype(np.uint32)
        ends = np.searchsorted((terms >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
        block = table.column("block")[0].as_py()
        return _table([(block, bucket, int(b - a), _packed(np.diff(terms[a:b], prepend=np.uint64(0))), _packed(held[a:b]))
                       for bucket, (a, b) in enumerate(zip(ends[:-1], ends[1:])) if a < b], _ASKED)

    folder = shared_dir(spark, "terms")
    told = _written(hashed.applyInArrow(ask, _ASKED).groupBy("bucket").applyInArrow(_answered, _TOLD), f"{folder}/told")
    frequent = sum((np.frombuffer(r.df, np.int64) for r in told.where("block < 0").select("df").collect()), np.zeros(_DOUBLINGS, np.int64))
    first = 1 << int(np.argmax(np.append(np.cumsum(frequent[::-1])[::-1], 0) <= FIRST_TERMS))

    def scores(least: int) -> DataFrame:
        """Scores of all terms in ``least`` documents or more."""
        def scored(left: pa.Table, right: pa.Table) -> pa.Table:
            terms, begins, row, tf, ids = _counted(left)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            df = np.concatenate([np.zeros(0, np.int64), *(_unpacked(r["df"], r["n"], np.uint32) for r in sorted(right.to_pylist(), key=lambda r: r["bucket"]))])
            x = tf * np.repeat(np.log((1 + n) / (1 + df)) + 1, np.diff(begins, append=len(row)))
            x /= np.sqrt(np.bincount(row, x * x, len(ids)))[row]
            held_by = np.maximum.reduceat(np.where(known[row], row, -1), begins) if len(row) else row
            kept = (df >= least) & (held_by >= 0)
            sums = np.add.reduceat(x * known[row], begins) if len(row) else x
            return pa.table([pa.array(terms[kept].view(np.int64)), pa.array(sums[kept]), ids.take(pa.array(held_by[kept]))], ["h", "score", "doc"])

        answers = told.where("block >= 0").select("block", "bucket", "n", "df").groupBy("block")
        sums = hashed.cogroup(answers).applyInArrow(scored, f"h bigint, score double, doc {doc}")
        return _written(sums.groupBy("h").agg(F.sum("score").alias("score"), F.min("doc").alias("doc")), f"{folder}/scores-{least}")

    found = scores(first)
    best = found.orderBy(F.desc("score")).limit(top).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).first()
    last = best.least if best.n == top else 0
    return found if first <= max(last, 1) else scores(max(int(last), 1))


#: Numbers of documents by powers of two.
_DOUBLINGS = 64


def _counted(table: pa.Table) -> tuple[np.ndarray, ...]:
    """A block's different terms in order, where each begins among the pairs of term and document, of these the document and how often, and the documents' ids."""
    ids, lists = table.column("doc").combine_chunks().dictionary_encode(null_encoding="encode"), table.column("hashes").combine_chunks()
    codes = ids.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    lists = lists.take(pa.array(order))
    row = np.repeat(codes[order].astype(np.int32), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    pair = new.copy()
    pair[1:] |= row[1:] != row[:-1]
    at = np.flatnonzero(pair)
    begins = np.flatnonzero(new[at])
    return values[at[begins]], begins, row[at], np.diff(at, append=len(values)), ids.dictionary


def _answered(table: pa.Table) -> pa.Table:
    """A bucket's numbers of documents, for each block in the order in which it asked; under block -1 how many terms have 1, 2 to 3, 4 to 7 … documents."""
    asked = table.to_pylist()
    terms = np.concatenate([np.cumsum(_unpacked(r["terms"], r["n"], np.uint64), dtype=np.uint64) for r in asked])
    different, place = np.unique(terms, return_inverse=True)
    df = np.bincount(place, np.concatenate([_unpacked(r["docs"], r["n"], np.uint32) for r in asked]), len(different)).astype(np.uint32)
    told, ends = df[place], np.cumsum([r["n"] for r in asked])
    sizes = np.bincount(np.frexp(df.astype(float))[1] - 1, minlength=_DOUBLINGS).astype(np.int64)
    bucket = asked[0]["bucket"]
    return _table([(r["block"], bucket, r["n"], _packed(told[b - r["n"]:b])) for r, b in zip(asked, ends)] + [(-1, bucket, len(df), sizes.tobytes())], _TOLD)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    names = [c.split() for c in schema.split(", ")]
    return pa.table([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(names)], [c for c, _ in names])


def _packed(x: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, so that what they share goes."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, n * width, codec="zstd"), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _written(df: DataFrame, folder: str) -> DataFrame:
    """The rows written and read again. They are computed once, so the shuffle files of that go when it ends."""
    spark: SparkSession = df.sparkSession
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(folder)
