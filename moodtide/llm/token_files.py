"""Token ids of documents in block files: every document is its own zstandard frame, all frames share one trained dictionary.

Format. A folder with two Parquet tables, so that any store Spark reaches can hold it:

* ``dictionary``: one row ``(dict_hash, id_bytes, dictionary)``; the hash is the SHA-256 of the dictionary bytes.
* ``blocks``: rows ``(part, block, first_id, last_id, part_start, doc_ids, n_tokens, frame_ends, dict_hash, payload)``. ``payload`` is
  the frames of the block's documents one after the other, ``frame_ends`` is the offset index into it, ``part_start`` counts the
  ids of the same part that come before. Parts ascend by document id, and blocks and documents inside a part do as well.

One document is read with its block's index row and one short frame (:func:`read_documents` with ``only``); the
identifiers at both ends of a block let Parquet skip the other blocks.

Defined cases: a null text is an empty one (just the end id); null ids come first; rows that repeat an id are all kept, in the
order of a hash of their texts; an empty table gives an empty block table; columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.llm.tokens import coder, encoded

#: Documents the dictionary is trained on (those with the smallest hashes), and bytes of each that training sees.
SAMPLE_DOCS, SAMPLE_BYTES = 1500, 1 << 14
DICTIONARY_BYTES = 1 << 16
#: A block is closed at this many compressed bytes or documents.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 4096
LEVEL = 6

BLOCK_SCHEMA = ("part int, block int, first_id bigint, last_id bigint, part_start bigint, doc_ids array<bigint>, n_tokens array<bigint>, "
                "frame_ends array<bigint>, dict_hash string, payload binary")
_BLOCK_ARROW = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("part_start", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("frame_ends", pa.list_(pa.int64())), ("dict_hash", pa.string()),
    ("payload", pa.binary())])


def train_dictionary(docs: DataFrame, text: str, tokenizer: str, end: int) -> bytes:
    """A dictionary from the serialized ids of at most ``SAMPLE_DOCS`` documents; empty when there is too little to train on."""
    sample = docs.orderBy(F.xxhash64(text)).limit(SAMPLE_DOCS)

    def serialized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, offsets in encoded(batches, text, tokenizer, end):
            rows = [ids[a:b].tobytes()[:SAMPLE_BYTES] for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

    samples = [bytes(r.ids) for r in sample.select(text).mapInArrow(serialized, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8)), samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too uniform samples
        return b""


def _writer(text: str, tokenizer: str, end: int, dictionary: bytes):
    dict_hash = hashlib.sha256(dictionary).hexdigest()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        part, block, start, total = TaskContext.get().partitionId(), 0, 0, 0
        ids_of: list = []
        counts: list[int] = []
        frames: list[bytes] = []
        size = 0

        def closed() -> pa.RecordBatch:
            present = [i for i in ids_of if i is not None]
            row = {"part": part, "block": block, "first_id": min(present, default=None), "last_id": max(present, default=None), "part_start": start,
                   "doc_ids": ids_of, "n_tokens": counts, "frame_ends": np.cumsum([len(f) for f in frames]).tolist(), "dict_hash": dict_hash,
                   "payload": b"".join(frames)}
            return pa.RecordBatch.from_pylist([row], _BLOCK_ARROW)

        for rows, ids, offsets in encoded(batches, text, tokenizer, end):
            for doc, a, b in zip(rows.column("id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                frame = press.compress(ids[a:b].tobytes())
                ids_of.append(doc)
                counts.append(b - a)
                frames.append(frame)
                size, total = size + len(frame), total + b - a
                if size >= BLOCK_BYTES or len(frames) >= BLOCK_DOCS:
                    yield closed()
                    block, start, size = block + 1, total, 0
                    ids_of, counts, frames = [], [], []
        if frames:
            yield closed()

    return write


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append ``end``, and write dictionary and blocks in ascending id order under ``folder``.

    The texts are dealt by ranges of (id, hash of the text), so that not even one id that repeats for ever fills a task.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dictionary = train_dictionary(rows, "text", tokenizer, end)
    header = [(hashlib.sha256(dictionary).hexdigest(), coder(tokenizer).dtype.itemsize, bytearray(dictionary))]
    spark.createDataFrame(header, "dict_hash string, id_bytes int, dictionary binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    dealt.mapInArrow(_writer("text", tokenizer, end, dictionary), BLOCK_SCHEMA).write.parquet(f"{folder}/blocks")


def read_documents(spark: SparkSession, folder: str, only: Sequence[int] | None = None) -> DataFrame:
    """``doc_id, part, start_in_part, n_tokens, ids`` of all documents, or of the ids in ``only``; ids are little-endian 32-bit integers."""
    header = spark.read.parquet(f"{folder}/dictionary").first()
    dictionary, dict_hash, width = bytes(header.dictionary), header.dict_hash, header.id_bytes
    if hashlib.sha256(dictionary).hexdigest() != dict_hash:
        raise ValueError("the dictionary does not have its hash")
    wanted = None if only is None else frozenset(only)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
    if only is not None:
        blocks = blocks.filter(F.array_contains(F.transform(
            F.array(*[F.lit(int(i)) for i in only]) if only else F.array().cast("array<bigint>"),
            lambda i: (F.col("first_id") <= i) & (F.col("last_id") >= i)), F.lit(True)) & (F.col("last_id") >= min(only, default=0)) & (F.col("first_id") <= max(only, default=0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        expand = zstandard.ZstdDecompressor(dict_data=shared)
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_hash"] != dict_hash:
                    raise ValueError("a block was written with another dictionary")
                payload, ends = memoryview(row["payload"]), row["frame_ends"]
                out: list[tuple] = []
                size, start = 0, row["part_start"]
                for doc, count, a, b in zip(row["doc_ids"], row["n_tokens"], [0, *ends[:-1]], ends):
                    if wanted is None or doc in wanted:
                        ids = np.frombuffer(expand.decompress(payload[a:b], max_output_size=count * width), f"<u{width}").astype("<u4").tobytes()
                        out.append((doc, row["part"], start, count, ids))
                        size += len(ids)
                    start += count
                    if size > 1 << 24:
                        yield _documents(out)
                        out, size = [], 0
                if out:
                    yield _documents(out)

    return blocks.select("part", "part_start", "doc_ids", "n_tokens", "frame_ends", "dict_hash", "payload").mapInArrow(
        read, "doc_id bigint, part int, start_in_part bigint, n_tokens bigint, ids binary")


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("doc_id", pa.int64()), ("part", pa.int32()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], [n for n, _ in kinds])


def part_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``part, part_offset``: the ids of all parts before; one row for each part, from the index columns alone."""
    totals = (spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks").select("part", F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n"))
              .groupBy("part").agg(F.sum("n").alias("n")))
    from pyspark.sql import Window

    return totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_offset"))
