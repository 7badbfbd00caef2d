"""Documents into as few token sequences as possible: dominance reduction, then best fit.

Sizes are whole numbers up to the capacity, so the instance is a histogram with at most ``capacity`` bars however many documents
there are. The driver plans on that histogram alone: runs of equal sequences, fixed by the reduction of Martello and Toth as long as
one set provably dominates all alternatives, the rest by best fit in descending size. Spark gives every piece its rank
among the pieces of its size, and the rank finds the piece's place in the plan. Nothing moves but one count for each task and size.

Defined cases: a null text is an empty one (a piece with the end id); a text longer than a sequence is cut into full pieces behind a
first piece that may be shorter; repeated rows are separate pieces; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodtide.llm.tokens import encoded

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, place bigint, ids binary"
_ARROW = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

#: One run of equal sequences: how many there are and what each holds, as (size, count).
Run = tuple[int, list[tuple[int, int]]]


class _Stock:
    """Sizes that are left, ascending, with their numbers."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: c for s, c in counts.items() if c > 0}
        self.sizes = sorted(self.n)

    def take(self, size: int, count: int) -> None:
        self.n[size] -= count
        if not self.n[size]:
            del self.n[size]
            self.sizes.remove(size)

    def largest(self, most: int) -> int | None:
        i = bisect_right(self.sizes, most)
        return self.sizes[i - 1] if i else None

    def smallest(self, k: int, above: int = 0) -> list[int]:
        out: list[int] = []
        for s in self.sizes[bisect_right(self.sizes, above):]:
            out += [s] * min(k - len(out), self.n[s])
            if len(out) == k:
                break
        return out


def _heaviest_pair(stock: _Stock, most: int) -> tuple[int, int] | None:
    """The two items of the largest sum up to ``most``, larger one first; of equal sums the one with the largest item."""
    best, low = None, 0
    for high in reversed(stock.sizes[:bisect_right(stock.sizes, most)]):
        if best and 2 * high < best[0] + best[1]:
            break
        i = bisect_right(stock.sizes, min(most - high, high)) - 1
        if i >= 0 and stock.sizes[i] == high and stock.n[high] < 2:
            i -= 1
        if i >= 0 and (low := high + stock.sizes[i]) and (best is None or low > best[0] + best[1]):
            best = (high, stock.sizes[i])
    return best


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Run], dict[int, int]]:
    """Runs that some best packing contains, and what is left when no more set is proven.

    For an item of size w with room r = capacity - w beside it, in descending w:

    * nothing fits: the item alone; * some size is exactly r: that pair; * two more items never fit: w with the largest fitting;
    * three more never fit, and the heaviest pair (a, b) holds the largest fitting size a, and no two items above b fit: the triple, as any
      other choice is covered item by item; or the largest single is at least as heavy as any pair: the pair with it.
    """
    stock = _Stock(counts)
    runs: list[Run] = []

    def fix(*items: int) -> None:
        need = {s: items.count(s) for s in items}
        times = min(stock.n[s] // k for s, k in need.items())
        for s, k in need.items():
            stock.take(s, times * k)
        runs.append((times, sorted(need.items(), reverse=True)))

    for w in sorted(counts, reverse=True):
        while stock.n.get(w):
            room = capacity - w
            stock.n[w] -= 1  # look at the others
            others = _Stock(stock.n)
            stock.n[w] += 1
            one = others.largest(room)
            if one is None:
                fix(w)
                continue
            least = others.smallest(3)
            if one == room or len(least) < 2 or least[0] + least[1] > room:
                fix(w, one)
                continue
            if len(least) < 3 or sum(least) > room:
                pair = _heaviest_pair(others, room)
                if pair is None or one >= sum(pair):
                    fix(w, one)
                    continue
                above = others.smallest(2, pair[1])
                if one == pair[0] and (len(above) < 2 or sum(above) > room):
                    fix(w, *pair)
                    continue
            break
    return runs, dict(stock.n)


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best fit in descending size; sequences with equal content are one run, so the work does not depend on the numbers."""
    open_: list[tuple[int, int]] = []  # (room, index of the run), ascending
    runs: list[list] = []

    def put(times: int, content: list[tuple[int, int]], room: int) -> None:
        if times:
            runs.append([times, content])
            insort(open_, (room, len(runs) - 1))

    for w in sorted(counts, reverse=True):
        left = counts[w]
        while left:
            i = bisect_left(open_, (w, -1))
            if i == len(open_):
                each = capacity // w
                put(left // each, [(w, each)], capacity - each * w)
                if left % each:
                    put(1, [(w, left % each)], capacity - left % each * w)
                break
            room, at = open_.pop(i)
            times, content = runs[at]
            each = room // w
            full = min(times, left // each)
            left -= full * each
            part = min(left, each) if full < times else 0
            left -= part
            runs[at][0] = times - full - bool(part)
            if runs[at][0]:
                insort(open_, (room, at))
            put(full, [*content, (w, each)], room - each * w)
            if part:
                put(1, [*content, (w, part)], room - part * w)
    return [(t, c) for t, c in runs if t]


def plan(counts: dict[int, int], capacity: int) -> list[Run]:
    fixed, rest = reduce_instance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def intervals(runs: list[Run]) -> dict[str, np.ndarray]:
    """Where the ranks of each size go: from rank ``low`` of ``size`` on, ``each`` to a sequence from ``first`` on, at ``offset``."""
    given: dict[int, int] = {}
    rows, first = [], 0
    for times, content in runs:
        offset = 0
        for size, each in content:
            rows.append((size, given.get(size, 0), first, each, offset))
            given[size] = given.get(size, 0) + times * each
            offset += size * each
        first += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("size", "low", "first", "each", "offset"), table.T))


def cut_pieces(docs: DataFrame, tokenizer: str, end: int, capacity: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of whole texts. ``part`` and ``place`` are the task and the rank in it among pieces of that length: write before use."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for rows, ids, offsets in encoded(batches, "text", tokenizer, end):
            out = []
            for doc, a, b in zip(rows.column("id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                at, piece = a, 0
                while at < b:
                    to = at + ((b - a) % capacity or capacity) if at == a else at + capacity
                    own = ids[at:to]
                    length = to - at
                    out.append((doc, piece, at - a, length, zlib.crc32(own.astype("<u4").tobytes()), part, seen[length], own.tobytes()))
                    seen[length] += 1
                    at, piece = to, piece + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _ARROW)], [c.split()[0] for c in PIECES.split(", ")])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def place_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``sequence_id`` and ``offset`` of each written piece (the ids stay where they are).

    The histogram, at most ``capacity`` rows, comes to the driver; the plan that goes to the tasks has a few rows for each size.
    """
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    offsets = counts.select("part", "length", before.alias("before"))
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = intervals(plan(histogram, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = table["size"] * (1 << 48) + table["low"]
        for batch in batches:
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            if not len(size):
                continue
            at = np.searchsorted(key, size * (1 << 48) + rank, "right") - 1
            turn = rank - table["low"][at]
            each = table["each"][at]
            columns = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(table["first"][at] + turn // each), pa.array(table["offset"][at] + turn % each * size)],
                [*columns, "sequence_id", "offset"])

    narrow = pieces.drop("ids")
    ranked = narrow.join(offsets, ["part", "length"]).withColumn("rank", F.col("before") + F.col("place")).drop("before")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, folder: str, tokenizer: str, end: int, capacity: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut, write the pieces with their ids to ``folder``, and return the pieces with their places."""
    cut_pieces(docs, tokenizer, end, capacity, doc_id, text).write.option("compression", "zstd").parquet(folder)
    return place_pieces(docs.sparkSession.read.schema(PIECES).parquet(folder), capacity)


def sequences(spark: SparkSession, folder: str, placed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the sequences themselves, at most one capacity of ids each."""
    whole = spark.read.schema(PIECES).parquet(folder).select("part", "length", "place", "ids")
    rows = placed.select("part", "length", "place", "sequence_id", "offset").join(whole, ["part", "length", "place"])
    row = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return rows.groupBy("sequence_id").agg(row.alias("r")).select(
        "sequence_id", F.aggregate("r", F.lit(0).cast("bigint"), lambda a, x: a + x["length"]).alias("n_tokens"),
        F.aggregate("r", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
