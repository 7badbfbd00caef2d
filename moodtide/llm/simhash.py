"""Near-duplicates by SimHash: tiled exact comparison of all different fingerprints.

Fingerprints are tiled by the population counts of their four quarters. Two fingerprints within radius r have counts that differ by r
in sum at most, so tile pairs beyond that are never formed; the others are compared whole, by exclusive-or and bit counts of numpy
arrays. A tile pair gives a star for each group of linked fingerprints in it, never all pairs. Equal fingerprints are one row from the
start, and a crowded cell is cut into several tiles, so neither copies nor crowded cells make a large task.

Defined cases: a null text is an empty one, with fingerprint zero like every text without words; null ids count as no id (a component of
null ids only has a null id); repeated rows are kept and share their component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.components import components
from moodtide.session import shared_dir

SEED = 42
TILE = 4096
_QUARTERS = 4
_SIDE = 64 // _QUARTERS + 1  # a quarter has 0 to 16 bits set
_BATCH = 1 << 15


def fingerprint(text: bytes, words: int) -> int:
    """Majority bits of the XXH64 hashes of all word shingles, as an unsigned number."""
    parts = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not parts:
        return 0
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(b" ".join(parts), SEED)
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate([[0], ends[:-words]]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BATCH):
        counts += np.unpackbits(hashes[at:at + _BATCH].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def text_mark(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def fingerprints(docs: DataFrame, words: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, mark, fp`` of every row: a hash of the text that tells rows of one id apart, and the fingerprint as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t, words) for t in batch.column("text").cast(pa.binary()).to_pylist()], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), pa.array(marks, pa.int64())], ["id", "mark", "fp"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), text_mark(text).alias("mark"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "id bigint, mark bigint, fp bigint")


def _quarter(place: int) -> Column:
    return F.bit_count(F.shiftrightunsigned("fp", place * 16).bitwiseAND(F.lit(0xFFFF).cast("bigint")))


def _cell() -> Column:
    code = F.lit(0)
    for place in range(_QUARTERS):
        code = code * _SIDE + _quarter(place)
    return code.cast("int")


def _neighbours(radius: int) -> list[tuple[int, ...]]:
    """Steps to the cells within the radius that come at or after a cell, so that each pair of cells meets once."""
    return [s for s in product(range(-radius, radius + 1), repeat=_QUARTERS) if sum(map(abs, s)) <= radius and s >= (0,) * _QUARTERS]


def _stars(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the pairs within the radius join: each linked fingerprint to the first of its group."""
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    for at in range(0, len(a), 256):
        rows, cols = np.nonzero(np.bitwise_count(a[at:at + 256, None] ^ b) <= radius)
        rows += at
        if same:
            rows, cols = rows[rows < cols], cols[rows < cols]
        left.append(rows)
        right.append(cols if same else cols + len(a))
    i, j = np.concatenate(left), np.concatenate(right)
    if not len(i):
        return a[:0], a[:0]
    every = a if same else np.concatenate([a, b])
    label = np.arange(len(every))
    while True:
        before = label.copy()
        np.minimum.at(label, j, label[i])
        np.minimum.at(label, i, label[j])
        label = label[label]
        if np.array_equal(before, label):
            break
    linked = np.flatnonzero(label != np.arange(len(every)))
    return every[linked], every[label[linked]]


def links(marks: DataFrame, radius: int) -> DataFrame:
    """``a, b``: links among the different fingerprints ``fp`` that connect exactly those that chains within the radius connect."""
    cells = marks.withColumn("cell", _cell())
    sizes = cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"))  # at most 17^4 rows
    dealt = cells.join(sizes, "cell").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")))
    tiles = dealt.groupBy("cell", "tile").agg(F.collect_list("fp").alias("fps"))
    folder = shared_dir(marks.sparkSession, "tiles")
    tiles.write.parquet(folder)
    tiles = marks.sparkSession.read.parquet(folder)
    steps = F.array(*[F.array(*[F.lit(x) for x in s]) for s in _neighbours(radius)])
    digits = [F.floor(F.col("cell") / _SIDE ** (_QUARTERS - 1 - p)).cast("int") % _SIDE for p in range(_QUARTERS)]
    there = [digits[p] + F.col("step")[p] for p in range(_QUARTERS)]
    inside = F.lit(True)
    code = F.lit(0)
    for p in there:
        inside = inside & p.between(0, _SIDE - 1)
        code = code * _SIDE + p
    left = tiles.select("cell", F.col("tile").alias("tile_a"), F.col("fps").alias("a"), F.explode(steps).alias("step")).filter(inside)
    left = left.select(code.alias("other"), (code == F.col("cell")).alias("own"), "tile_a", "a")
    right = tiles.select(F.col("cell").alias("other"), F.col("tile").alias("tile_b"), F.col("fps").alias("b"))
    pairs = left.join(right, "other").filter(~F.col("own") | (F.col("tile_a") <= F.col("tile_b")))
    pairs = pairs.select("a", "b", (F.col("own") & (F.col("tile_a") == F.col("tile_b"))).alias("same"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flats = []
            for name in ("a", "b"):
                column = batch.column(name)
                bounds = column.offsets.to_numpy()
                flats.append((column.values.to_numpy().view(np.uint64), bounds))
            found = []
            for row, same in enumerate(batch.column("same").to_pylist()):
                a, b = (values[bounds[row]:bounds[row + 1]] for values, bounds in flats)
                found.append(_stars(a, b, radius, same))
            if found:
                ends = [np.concatenate(x).view(np.int64) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], ["a", "b"])

    return pairs.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = 5, radius: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, mark, fp, component_id, root`` of every row; a component is named by its smallest id, and ``root`` is one of its fingerprints."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "fingerprints")
    fingerprints(docs, words, doc_id, text).write.parquet(folder)
    rows = spark.read.parquet(folder)
    marks = rows.groupBy("fp").agg(F.min("id").alias("first"))
    roots = components(links(marks.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = marks.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(rooted.join(named, "root").select("fp", "component_id", "root"), "fp").select("id", "mark", "fp", "component_id", "root")


def hexadecimal(fp: str) -> Column:
    """A fingerprint as 16 lowercase digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
