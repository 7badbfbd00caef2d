"""Line dedup by a deletion-neighbourhood join: of lines within one edited word, the earliest in the corpus stays.

A line is its sequence of words, with A-Z lowered; lines with no word are always kept. Equal lines repeat whatever their length. Of lines with at least
``least_words`` words, a later one also goes when it differs from any earlier line by one word that is changed, put in or left out: for five words that is a
similarity of 0.8. "Earlier" does not ask whether that line stays itself, so the result does not depend on an order of work.

1. Each line gets a hash that is a polynomial of its words' hashes, so that the hash of the line without word i comes from prefix sums.
2. Lines that can have a partner share the hash of a half with another line: one edit leaves the first or the last half whole. A bitmap of fixed size
   marks the halves that different lines share.
3. Marked lines emit every variant with one word deleted as a hashed key: lines with equal variants at one place differ in that word, a line
   that equals a variant lacks that word. Keys reduce to the earliest line on each side, which is all the others need; no pairs inside a group.
4. Each line and its earlier partner are compared word by word.

Order: id, then a hash of the text (for rows that repeat an id), then line. Defined cases: null texts are empty; rows without lines to remove stay as they are; a
text all of whose lines go is empty; rows that repeat id and text are one row and get one result; null ids come first; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtide.llm.flat import LOWER, SPACE, slices, text_buffer
from moodtide.session import shared_dir

LEAST_WORDS = 5
#: Bits of the bitmap and of one of its pieces. A fuller bitmap lets more lines pass, and no fewer.
BITMAP_BITS, PIECE_BITS = 1 << 27, 1 << 17
#: Words of 64 bits of the map of texts that lose a line, at most.
MAP_WORDS = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_BASES = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x27D4EB2F165667C5))
_LINE = "id bigint, mark bigint, line int, h bigint, g int, n int"
#: Bytes of text whose lines are hashed at a time.
HASH_BYTES = 4 << 20


def _powers(base: np.uint64, many: int) -> np.ndarray:
    out = np.full(max(1, many), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(35)
    x *= np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


class _Lines:
    """Lines of a slice of texts with their words' hashes; everything is arrays over bytes, words or lines."""

    def __init__(self, texts: pa.Array):
        data, offsets = text_buffer(texts)
        breaks = np.flatnonzero(data == 0x0A) + 1
        bounds = np.unique(np.concatenate([offsets, breaks[breaks < len(data)]])) if len(data) else np.zeros(1, np.int64)
        self.data, self.bounds = data, bounds
        self.row = np.searchsorted(offsets, bounds[:-1], "right") - 1
        first = np.searchsorted(bounds[:-1], offsets[:-1])
        self.line = np.arange(len(self.row)) - first[self.row] if len(self.row) else self.row
        solid = ~SPACE[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]  # a line break is white space, and so is the end of a row for the row after
        begins[bounds[:-1]] = solid[bounds[:-1]]
        starts = np.flatnonzero(begins)
        self.firsts = np.searchsorted(starts, bounds)
        self.n = np.diff(self.firsts)
        self.word, check = self._words(LOWER[data[solid]], np.cumsum(solid)[starts] - 1 if len(starts) else starts)
        place = np.arange(len(starts)) - np.repeat(self.firsts[:-1], self.n)
        self.ups = _powers(_BASE, int(self.n.max(initial=0)) + 1)
        self.downs = _powers(_INVERSE, int(self.n.max(initial=0)) + 1)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(self.word * self.ups[place], dtype=np.uint64)])
        self.h = self.part(0, self.n)
        checks = np.concatenate([[np.uint64(0)], np.cumsum(check * self.ups[place], dtype=np.uint64)])
        self.g = ((checks[self.firsts[1:]] - checks[self.firsts[:-1]]) >> np.uint64(32)).astype(np.uint32).view(np.int32)

    @staticmethod
    def _words(letters: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """Two hashes of each word: polynomials of its bytes, scrambled."""
        if not len(starts):
            return [np.zeros(0, np.uint64)] * 2
        sizes = np.diff(np.append(starts, len(letters)))
        place = np.arange(len(letters), dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes)
        wide = letters.astype(np.uint64) + np.uint64(1)
        return [_scrambled(np.add.reduceat(wide * _powers(base, int(sizes.max()))[place], starts)) for base in _BYTE_BASES]

    def part(self, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
        """Hash of the words from a to b of each line, as if they stood at its start."""
        begin = self.firsts[:-1]
        return (self.sums[begin + b] - self.sums[begin + a]) * self.downs[a]

    def halves(self) -> np.ndarray:
        """Keys of the first and last half of each line, for partners of the same length and of one word less: lines x 4."""
        keys = []
        for less in (0, 1):
            length = np.maximum(self.n - less, 0)
            head = length // 2
            tail = length - head
            tag = length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            keys += [self.part(np.zeros_like(head), head) ^ tag, ~(self.part(self.n - tail, self.n) ^ tag)]
        return np.stack(keys, axis=1)


def _bits(h: np.ndarray) -> list[np.ndarray]:
    u = h.view(np.uint64)
    return [(u % np.uint64(BITMAP_BITS)).astype(np.int64), ((u >> np.uint64(32)) % np.uint64(BITMAP_BITS)).astype(np.int64)]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, _Lines]]:
    for part in slices(batch, "text", HASH_BYTES):
        yield part, _Lines(part.column("text"))


def _columns(part: pa.RecordBatch, lines: _Lines, at: np.ndarray) -> list[pa.Array]:
    row = pa.array(lines.row[at])
    return [part.column("id").take(row), part.column("mark").take(row), pa.array(lines.line[at].astype(np.int32)),
            pa.array(_signed(lines.h[at])), pa.array(lines.g[at]), pa.array(lines.n[at].astype(np.int32))]


def _numbered_lines(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _LINE.split(", ")]
    for batch in batches:
        for part, lines in _rows(batch):
            at = np.flatnonzero(lines.n > 0)
            keys = _signed(lines.halves()[at].ravel()).reshape(-1, 4)
            long = np.zeros(len(at), bool)
            long[np.unique(lines.h[at], return_index=True)[1]] = True  # once for equal lines of the slice
            long &= lines.n[at] >= least
            offsets = np.concatenate([[0], np.cumsum(np.where(long, 4, 0))]).astype(np.int32)
            halves = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[long].ravel()))
            yield pa.RecordBatch.from_arrays([*_columns(part, lines, at), halves], [*names, "halves"])


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """A bitmap over a column of hashes, built in pieces on the executors; ``BITMAP_BITS`` / 8 bytes come to the driver, whatever the rows."""
    bits = F.array(F.expr(f"pmod({column}, {BITMAP_BITS}L)"), F.expr(f"pmod(shiftrightunsigned({column}, 32), {BITMAP_BITS}L)"))
    places = hashes.select(F.explode(bits).alias("bit")).select((F.col("bit") / PIECE_BITS).cast("int").alias("piece"), (F.col("bit") % PIECE_BITS).cast("int").alias("at")).distinct()

    def piece(table: pa.Table) -> pa.Table:
        set_ = np.zeros(PIECE_BITS, bool)
        set_[table.column("at").to_numpy()] = True
        return pa.table({"piece": table.column("piece").slice(0, 1), "bits": pa.array([np.packbits(set_).tobytes()], pa.binary())})

    out = np.zeros(BITMAP_BITS // 8, np.uint8)
    for row in places.groupBy("piece").applyInArrow(piece, "piece int, bits binary").collect():
        out[row.piece * PIECE_BITS // 8:(row.piece + 1) * PIECE_BITS // 8] = np.frombuffer(row.bits, np.uint8)
    return out


def _marked(h: np.ndarray, shared: np.ndarray) -> np.ndarray:
    out = np.ones(len(h), bool)
    for bit in _bits(h):
        out &= (shared[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1).astype(bool)
    return out


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether the word sequences differ by one word at most."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, side, rank``: one row for each deleted word as a place (side 2), one as a shorter line (side 1), and the line itself (side 0)."""
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            lines = _Lines(part.column("text"))  # one line a row
            if not len(lines.n):
                continue
            rank = part.column("rank").to_numpy()[lines.row]
            n = lines.n
            own = np.repeat(np.arange(len(n)), n)
            begin = lines.firsts[:-1][own]
            at = np.arange(len(own))
            before = lines.sums[at] - lines.sums[begin]
            after = (lines.sums[lines.firsts[1:][own]] - lines.sums[at + 1]) * _INVERSE
            variant = before + after
            tag = (np.uint64(0xD6E8FEB86659FD93) * (n[own].astype(np.uint64) - np.uint64(1)))
            place = (variant ^ tag) + (at - begin + 1).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
            self_ = lines.h ^ (np.uint64(0xD6E8FEB86659FD93) * n.astype(np.uint64))
            keys = np.concatenate([~place, variant ^ tag, self_])
            side = np.concatenate([np.full(len(own), 2, np.int8), np.full(len(own), 1, np.int8), np.zeros(len(n), np.int8)])
            yield pa.RecordBatch.from_arrays([pa.array(_signed(keys)), pa.array(side), pa.array(np.concatenate([rank[own], rank[own], rank]))], ["key", "side", "rank"])


def near_repeats(docs: DataFrame, lines: DataFrame, least: int) -> DataFrame:
    """``h, g, n`` of the different lines that lie within one word of an earlier line."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "near-lines")
    halves = lines.filter(F.size("halves") > 0).select(F.explode("halves").alias("half"), "h")
    shared_halves = halves.groupBy("half").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("half")
    marks = spark.sparkContext.broadcast(bitmap(shared_halves, "half"))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in _rows(batch):
                at = np.flatnonzero(own.n >= least)
                at = at[_marked(_signed(own.halves()[at].ravel()), marks.value).reshape(-1, 4).any(axis=1)]
                columns = _columns(part, own, at)
                order = np.lexsort([columns[2].to_numpy(), columns[1].to_numpy(), columns[0].fill_null(-1 << 63).to_numpy(), own.g[at], own.h[at]])
                h, g = own.h[at[order]], own.g[at[order]]
                new = np.ones(len(order), bool)  # the earliest of equal lines of the slice
                new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
                at = at[order[new]]
                texts = [b" ".join(own.data[own.bounds[i]:own.bounds[i + 1]].tobytes().lower().split()) for i in at]
                yield pa.RecordBatch.from_arrays([*_columns(part, own, at), pa.array(texts, pa.binary())], [*(c.split()[0] for c in _LINE.split(", ")), "text"])

    found = docs.mapInArrow(candidates, f"{_LINE}, text binary").groupBy("h", "g", "n").agg(
        F.min(F.struct("id", "mark", "line")).alias("first"), F.first("text").alias("text"))
    placed = found.repartitionByRange("first").sortWithinPartitions("first").select("h", "g", "n", "text")

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            yield batch.append_column("rank", pa.array(np.arange(at, at + batch.num_rows)))
            at += batch.num_rows

    placed.mapInArrow(ranked, "h bigint, g int, n int, text binary, rank bigint").write.parquet(f"{folder}/lines")
    placed = spark.read.parquet(f"{folder}/lines")
    rows = placed.select("text", "rank").mapInArrow(_variants, "key bigint, side tinyint, rank bigint")
    least_of = lambda side: F.min(F.when(F.col("side") == side, F.col("rank"))).alias(f"least_{side}")
    keys = rows.groupBy("key").agg(*[least_of(s) for s in (0, 1, 2)], F.min("rank").alias("a"), F.max("rank").alias("b")).filter("a <> b").drop("a", "b")
    partner = F.when(F.col("side") == 0, F.col("least_1")).when(F.col("side") == 1, F.col("least_0")).otherwise(F.col("least_2"))
    pairs = rows.join(keys, "key").select("rank", partner.alias("partner")).filter("partner < rank").distinct()
    said = placed.select("rank", "h", "g", "n", "text").join(pairs, "rank").join(placed.select(F.col("rank").alias("partner"), F.col("text").alias("other")), "partner")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right = [within_one(a.split(), b.split()) for a, b in zip(batch.column("text").to_pylist(), batch.column("other").to_pylist())]
            yield batch.filter(pa.array(right, pa.bool_())).select(["h", "g", "n"])

    return said.select("h", "g", "n", "text", "other").mapInArrow(verified, "h bigint, g int, n int").distinct()


def line_dedup(docs: DataFrame, least_words: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with its texts rid of repeated lines, and ``n_lines`` (with a word) and ``n_removed``, which replace columns of these names."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "lines")
    docs = docs.drop("n_lines", "n_removed")
    own = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own.mapInArrow(lambda b: _numbered_lines(b, least_words), f"{_LINE}, halves array<bigint>").write.parquet(f"{folder}/lines")
    lines = spark.read.parquet(f"{folder}/lines")
    again = lines.groupBy("h", "g", "n").agg(F.min(F.struct("id", "mark", "line")).alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1").drop("times")
    near = near_repeats(own, lines, least_words).withColumn("near", F.lit(True))
    bad = again.join(near, ["h", "g", "n"], "full")
    here = F.struct("id", "mark", "line")
    gone = lines.drop("halves").join(bad, ["h", "g", "n"]).filter(F.col("near").isNotNull() | (F.col("first") < here))
    gone.groupBy("id", "mark").agg(F.collect_set("line").alias("_gone_")).write.parquet(f"{folder}/removed")
    removed = spark.read.parquet(f"{folder}/removed")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row_")
    keyed = docs.select(row, F.col(doc_id).cast("bigint").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"))
    # a map of the texts that lose a line, of a bounded size, is broadcast: the others go on without a shuffle, and a fuller map only lets more of them meet the lines
    words = min(MAP_WORDS, max(64, 1 << (removed.count() // 4).bit_length()))
    word, bit = (lambda c: F.pmod(F.shiftrightunsigned(c, 6), F.lit(words)).cast("int")), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("mark").bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
    some = removed.select(word(F.col("mark")).alias("word"), bit.alias("bits")).unionByName(spark.range(words).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits")))
    table = some.groupBy("word").agg(F.bit_or("bits").alias("bits")).groupBy(F.lit(0).cast("bigint").alias("one")).agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("map"))
    table.write.parquet(f"{folder}/map")  # one row, joined by a key of every text
    told = keyed.withColumn("one", F.col("mark").bitwiseAND(F.lit(0).cast("bigint"))).join(F.broadcast(spark.read.parquet(f"{folder}/map")), "one", "left")
    met = F.coalesce(F.get("map", word(F.col("mark"))).bitwiseAND(bit) != 0, F.lit(False))
    d, r = told.where(met).select("_row_", "id", "mark").alias("d"), removed.alias("r")
    both = d.join(r.hint("merge"), F.col("d.id").eqNullSafe(F.col("r.id")) & (F.col("d.mark") == F.col("r.mark")), "left").select("_row_", "_gone_")
    both = both.unionByName(told.where(~met).select("_row_", F.lit(None).cast("array<int>").alias("_gone_")))
    both = both.select("_row_.*", "_gone_")
    column = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_removed = [], [], []
            for t, out in zip(batch.column(column).to_pylist(), batch.column("_gone_").to_pylist()):
                own_lines = (t or "").split("\n")
                n_lines.append(sum(1 for x in own_lines if x.strip(" \t\n\x0b\x0c\r")))
                n_removed.append(len(out or ()))
                if out:
                    out = set(out)
                    t = "\n".join(x for i, x in enumerate(own_lines) if i not in out)
                kept.append(t)
            arrays = [pa.array(kept, pa.string()) if i == column else c for i, c in enumerate(batch.columns) if batch.schema.names[i] != "_gone_"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
                                             [*(c for c in batch.schema.names if c != "_gone_"), "n_lines", "n_removed"])

    schema = T.StructType([f for f in both.schema.fields if f.name != "_gone_"]).add("n_lines", T.LongType()).add("n_removed", T.LongType())
    return both.mapInArrow(cut, schema)
