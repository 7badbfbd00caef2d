"""Near-duplicates by the similarity of their sets of word shingles, exactly: texts of Jaccard similarity 0.8 or more are linked.

Two sets of such similarity share a shingle among the first n - ceil(0.8 n) + 1 of each, in any order that is the same for all texts. So a text hands out
only these, a fifth of its shingles, and texts that meet at one are compared: by bits that tell for certain when too many shingles differ, a few where they meet and all after that,
then whole. Shingles that a sample of the texts holds often come last in the order: a common
passage then brings few texts together. The order decides the work, never the result.

Links that a cheaper method proposes, those of close fingerprints, are verified first, by the same bits and whole sets; what they connect needs no further comparison.
The shingles then find what the proposal leaves out, so it decides the work, never the result.

Texts that meet at a shingle are compared with the first of them, then with the next few, then with all others; those that are connected by then are not
compared again. So a group of near copies costs its size and not the square of it. Equal sets are one node from the start.

Defined cases: a null text is an empty one, and texts without words are alike; a text of fewer words than a shingle is one shingle; repeated rows are kept and share their root;
an empty table gives no rows; other columns are ignored. Words, shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.llm.components import components
from moodtide.llm.flat import slices, text_buffer
from moodtide.llm.flat import words as words_of
from moodtide.llm.simhash import text_mark
from moodtide.llm.suffix_tree import _mix
from moodtide.session import shared_dir

#: One text in so many is looked at for common shingles, and at most so many of these are told to the tasks.
SAMPLE, COMMON = 16, 1 << 19
#: Texts at a shingle that the others are compared with, by round; all after that.
LEADERS = (1, 8, 64)
#: Shingles that one task brings together.
TASK_SHINGLES = 500_000
#: Bits of the map of texts that are read again.
MAP_BITS = 23

#: Words of 64 bits that texts are compared by where they meet.
FOLD = 4
_FOLDS = [f"fold_{i}" for i in range(FOLD)]

_SHORT = np.uint64(0x632BE59BD9B4E019)


def similar(shared: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of sizes a and b with so many common members have a Jaccard similarity of 0.8 at least; in whole numbers."""
    return 5 * shared >= 4 * (a + b - shared)


def prefix(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1 if n else 0


def sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted different shingle hashes of each text."""
    codes, distinct, firsts = words_of(*text_buffer(texts))
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()], np.uint64)[codes]
    windows = max(len(hashes) - words + 1, 0)
    x = hashes[:windows]
    for k in range(1, words):
        x = _mix(x, hashes[k:windows + k])
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= words or a == b:
            out.append(np.unique(x[a:max(b - words + 1, a)]))
        else:
            y = hashes[a:a + 1] ^ _SHORT
            for k in range(a + 1, b):
                y = _mix(y, hashes[k:k + 1])
            out.append(y)
    return out


def _node(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes())).view(np.int64))


def _common(rows: DataFrame, words: int, sample: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes that the sample holds most often, at most ``most``, and how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = np.concatenate(sets(part.column("text"), words))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["h"])

    spark = rows.sparkSession
    folder = shared_dir(spark, "common")
    some = rows.filter(F.pmod("mark", F.lit(sample)) == 0).select("text")
    some.mapInArrow(run, "h bigint").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").write.parquet(folder)
    counted = spark.read.schema("h bigint, n bigint").parquet(folder)
    least, told = None, 0
    for r in sorted(counted.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).collect(), key=lambda r: -r.n):
        told += r.rows
        if told > most:
            break
        least = r.n
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = counted.filter(F.col("n") >= least).toArrow()
    hashes = got.column("h").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], got.column("n").to_numpy()[order]


def _first(common: tuple[np.ndarray, np.ndarray], shingles: np.ndarray) -> np.ndarray:
    """The rarest shingles, as many as a similar set must meet one of."""
    hashes, counts = common
    most = prefix(len(shingles))
    if not len(hashes) or not most:
        return shingles[:most]
    at = np.minimum(np.searchsorted(hashes, shingles), len(hashes) - 1)
    return shingles[np.lexsort((shingles, np.where(hashes[at] == shingles, counts[at], 0)))[:most]]


def _nodes(rows: DataFrame, words: int, common) -> DataFrame:
    """``id, mark, node, n, keys, bits`` of every row; keys and bits once for each node of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                found = sets(part.column("text"), words)
                nodes = [_node(s) for s in found]
                keys, bits, folds = [], [], [_fold(s) for s in found]
                for node, s in zip(nodes, found):
                    keys.append(_first(common.value, s).view(np.int64) if node not in seen else np.zeros(0, np.int64))
                    bits.append(_parity(s) if node not in seen else None)
                    seen.add(node)
                ends = np.cumsum([0, *map(len, keys)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("mark"), pa.array(nodes, pa.int64()), pa.array([len(s) for s in found], pa.int64()), lists, pa.array(bits, pa.binary()),
                     *(pa.array([f[i] for f in folds], pa.int64()) for i in range(FOLD))],
                    ["id", "mark", "node", "n", "keys", "bits", *_FOLDS])

    return rows.mapInArrow(run, "id bigint, mark bigint, node bigint, n bigint, keys array<bigint>, bits binary, " + ", ".join(f"{c} bigint" for c in _FOLDS))


_MET = "key bigint, node bigint, n bigint"


def _groups(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns by key and node, each node of a key once, and the bounds of the keys."""
    columns = [table.column(c).to_numpy() for c in table.column_names]
    order = np.lexsort((columns[1], columns[0]))
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
    columns = [c[new] for c in columns]
    return columns, np.append(np.flatnonzero(np.diff(columns[0], prepend=columns[0][:1] - 1)), len(columns[0]))


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys that several nodes hold."""
    batches = list(batches)
    if sum(b.num_rows for b in batches):
        columns, bounds = _groups(pa.Table.from_batches(batches))
        sizes = np.diff(bounds)
        kept = np.repeat(sizes > 1, sizes)
        yield from pa.table([c[kept] for c in columns], ["key", "node", "n"]).to_batches(1 << 16)


def _candidates(done: int, leaders: int | None):
    """Pairs of differently rooted nodes of a key, of which one is a leader of this round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        (_, node, n, root, *folds), bounds = _groups(pa.Table.from_batches(batches))
        folds = [f.view(np.uint64) for f in folds]  # bits of a negative number would be counted as those of its opposite
        left, right, held = [], [], 0
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a <= done + 1 or (root[a:b] == root[a]).all():
                continue
            for at in range(a + done, b - 1 if leaders is None else min(b - 1, a + leaders)):
                rest = slice(at + 1, b)
                small, large = np.minimum(n[at], n[rest]), np.maximum(n[at], n[rest])
                differ = sum(np.bitwise_count(f[rest] ^ f[at]).astype(np.int64) for f in folds)  # not more than the shingles that only one of them holds
                to = node[rest][(root[rest] != root[at]) & (5 * small >= 4 * large) & (9 * differ <= n[rest] + n[at])]
                left.append(np.full(len(to), node[at]))
                right.append(to)
                held += len(to)
                if held > 1 << 20:
                    yield pairs(left, right)
                    left, right, held = [], [], 0
        if held:
            yield pairs(left, right)

    def pairs(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
        found = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return run


def _sets_of(rows: DataFrame, words: int, wanted: DataFrame, folder: str) -> DataFrame:
    """``node, shingles`` of the wanted nodes, written to the folder, from the texts of their marks; a map of bits leaves most other texts out before they are cut into words."""
    at = F.shiftrightunsigned("mark", 64 - MAP_BITS)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(mark, {64 - MAP_BITS}) & 63 AS INT))")
    bits = wanted.groupBy(F.shiftright(at, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    marked = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    marked[bits.column("at").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    told = rows.sparkSession.sparkContext.broadcast(marked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("mark").to_numpy().view(np.uint64) >> np.uint64(64 - MAP_BITS)
            kept = batch.filter(pa.array((told.value[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)))
            for part in slices(kept, "text"):
                found = sets(part.column("text"), words)
                yield pa.RecordBatch.from_arrays([part.column("mark"), pa.array([x.tobytes() for x in found], pa.binary())], ["mark", "shingles"])

    held = rows.select("mark", "text").mapInArrow(run, "mark bigint, shingles binary")
    held.join(wanted, "mark").groupBy("node").agg(F.first("shingles").alias("shingles")).write.parquet(folder)
    told.destroy()
    return rows.sparkSession.read.parquet(folder)


def _fold(shingles: np.ndarray) -> list[int]:
    """The parity bits of a set on a few words."""
    counts = np.bincount((shingles & np.uint64(64 * FOLD - 1)).astype(np.int64), minlength=64 * FOLD)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8").tolist()


def _parity(shingles: np.ndarray) -> bytes:
    """Bits, at least as many as shingles: each is set when an odd number of shingles falls on it."""
    size = max(64, 1 << max(len(shingles) - 1, 0).bit_length())
    counts = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs without those that differ too much for certain: a shingle in one set only changes one bit, and similar sets differ by a ninth of both sizes at most."""
    for batch in batches:
        kept = []
        for x, y, n in zip(batch.column("bits_a"), batch.column("bits_b"), batch.column("n").to_pylist()):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            if len(x) < len(y):
                x, y = y, x
            while len(x) > len(y):
                x = x[:len(x) // 2] ^ x[len(x) // 2:]
            kept.append(9 * int(np.bitwise_count(x ^ y).sum()) <= n)
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets are similar."""
    for batch in batches:
        kept = []
        for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b")):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            at = np.searchsorted(y, x)
            shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
            kept.append(bool(similar(shared, len(x), len(y))))
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _proposed(nodes: DataFrame, fingerprints: DataFrame, near: DataFrame) -> DataFrame:
    """``a, b``: nodes of one fingerprint, each with the first of them, and the first nodes of linked fingerprints."""
    held = fingerprints.select("mark", "fp").distinct().join(nodes.select("mark", "node").distinct(), "mark").select("fp", "node").distinct()
    first = held.groupBy("fp").agg(F.min("node").alias("first"))
    same = held.join(first, "fp").select(F.col("first").alias("a"), F.col("node").alias("b"))
    one, two = (first.select(F.col("fp").alias(e), F.col("first").alias(f"node_{e}")) for e in "ab")
    across = near.join(one, "a").join(two, "b").select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
    return same.unionByName(across).where("a <> b").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, most: int = COMMON,
                    fingerprints: DataFrame | None = None, near: DataFrame | None = None) -> DataFrame:
    """``id, mark, root`` of every row; rows share a root when chains of similar texts connect them.

    ``fingerprints`` (mark, fp) and ``near`` (a, b: linked fingerprints) propose links that are verified before the shingles are asked.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "shingles")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), text_mark(text).alias("mark"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    common = spark.sparkContext.broadcast(_common(rows, words, sample, most))
    _nodes(rows, words, common).write.parquet(f"{folder}/nodes")
    common.destroy()
    nodes = spark.read.parquet(f"{folder}/nodes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = lambda n: max(parts, -(-(n or 0) // TASK_SHINGLES))
    handed = nodes.agg(F.sum(F.size("keys"))).first()[0]
    nodes.select(F.explode("keys").alias("key"), "node", "n").repartition(spread(handed), "key").mapInArrow(_met, _MET).write.parquet(f"{folder}/met")
    met = spark.read.schema(_MET).parquet(f"{folder}/met")
    size, widest = met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    if size:
        alone = met.select("node").distinct()
        nodes.filter("bits IS NOT NULL").join(alone, "node", "left_semi").groupBy("node").agg(F.min("mark").alias("mark"), F.min("n").alias("n"), F.min("bits").alias("bits"), *[F.min(c).alias(c) for c in _FOLDS]).write.parquet(f"{folder}/sketches")
        sketches = spark.read.parquet(f"{folder}/sketches")
        met.join(sketches.select("node", *_FOLDS).hint("merge"), "node").select("key", "node", "n", *_FOLDS).write.parquet(f"{folder}/folded")
        met = spark.read.parquet(f"{folder}/folded")
    links: list[str] = []

    def verified(pairs: DataFrame, step: str) -> DataFrame | None:
        """Roots of all links so far and those of the pairs that hold; None when no pair is possible. A node that meets no other at a shingle has no similar one."""
        one, two = (sketches.select(F.col("node").alias(e), F.col("n").alias(f"n_{e}"), F.col("bits").alias(f"bits_{e}")) for e in "ab")
        pairs = pairs.join(one, "a").join(two, "b").select("a", "b", "bits_a", "bits_b", (F.col("n_a") + F.col("n_b")).alias("n"))
        pairs.mapInArrow(_possible, "a bigint, b bigint").write.parquet(f"{folder}/pairs/{step}")
        pairs = spark.read.schema("a bigint, b bigint").parquet(f"{folder}/pairs/{step}")
        if pairs.isEmpty():
            return None
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sketches.select("node", "mark").join(ends, "node", "left_semi").write.parquet(f"{folder}/wanted/{step}")
        found = _sets_of(rows, words, spark.read.parquet(f"{folder}/wanted/{step}"), f"{folder}/sets/{step}")
        one, two = (found.select(F.col("node").alias(e), F.col("shingles").alias(f"shingles_{e}")) for e in "ab")
        pairs.join(one, "a").join(two, "b").select("a", "b", "shingles_a", "shingles_b").mapInArrow(_verified, "a bigint, b bigint").write.parquet(f"{folder}/links/{step}")
        links.append(f"{folder}/links/{step}")
        components(spark.read.schema("a bigint, b bigint").parquet(*links)).write.parquet(f"{folder}/roots/{step}")
        return spark.read.schema("node bigint, root bigint").parquet(f"{folder}/roots/{step}")

    roots = verified(_proposed(nodes, fingerprints, near), "near") if size and near is not None else None
    done = 0
    for step, leaders in enumerate((*LEADERS, None)):
        if not size or widest <= done + 1:
            break
        rooted = met.select("key", "node", "n", F.col("node").alias("root"), *_FOLDS) if roots is None else met.join(roots.withColumnRenamed("root", "r"), "node", "left").select("key", "node", "n", F.coalesce("r", "node").alias("root"), *_FOLDS)
        pairs = rooted.repartition(spread(size), "key").mapInArrow(_candidates(done, leaders), "a bigint, b bigint").distinct()
        done = leaders
        now = verified(pairs, str(step))
        roots = roots if now is None else now
    if roots is None:
        return nodes.select("id", "mark", F.col("node").alias("root"))
    return nodes.join(roots, "node", "left").select("id", "mark", F.coalesce("root", "node").alias("root"))
