"""A probabilistic suffix tree over words: contexts of zero to two words, kept where they change what comes next, and texts scored by it.

The symbols of a text are its words (A-Z lowered) and one end. The root gives a symbol with count c the probability (c + 1) / (N + 1 * (V + 1)), the one that was not seen
included. A context s of count c(s) spreads (c(s, w) - 1) / c(s) over the symbols that followed it at least twice; what is left, one for each different
symbol that followed, goes by the distribution of the longest kept context that s ends in. So all distributions are smoothed and add up to one.
A context is kept when it came ``least_count`` times, however large the corpus, and the divergence of its distribution from its parent's, times its count, reaches ``least_gain``
(in nats; taken over the symbols seen twice and the rest as one). A symbol is scored in the longest kept context before it.

How it runs. Texts are tokenized once into blocks of about ``BLOCK_TOKENS`` symbols, a bucketed table of codes and 64-bit hashes of words. A block asks for the corpus
counts of its different n-grams: it sends sorted hashes with its own training counts, dealt by hash to buckets, and a bucket answers with the totals in
the order of the question. A common context is spread over all buckets, for n-grams are dealt whole, and every block has already summed its own. With counts, a block adds
the n-grams it answers for to the divergence of their contexts, which buckets sum in the same way. Nothing is sent by token, and blocks stay where they are.

What is sent is kept small. An n-gram came no oftener than the shorter ones in it, and one that came once counts for nothing: pairs are asked after the words, triples after the
pairs, and only where the context came ``least_count`` times and the end of the n-gram twice. Buckets number the words and the pairs that are contexts, in the order of their keys, and
tell the numbers with the counts. A pair is then two numbers, a triple the number of its pair and that of a word; both lie with their context, or, when that came oftener than a
``HOT``-th of a bucket, spread over all buckets. A question about a context takes a bit or two. Answers are written by block, once, and no later step moves them.

Words are told apart by 64-bit hashes, n-grams by the numbers of their words. Defined cases: null texts are empty (only the end); null ids are learned from; repeated rows are scored one by
one and learned from as often; with nothing to learn from all scores are 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.flat import slices, text_buffer, words
from moodtide.session import shared_dir

BLOCK_TOKENS = 1_500_000
#: Symbols of the corpus to a bucket, so that its questions fit in a task.
BUCKET_TOKENS = 2_000_000
#: A context that came oftener than this part of a bucket's symbols has its n-grams spread over all buckets.
HOT = 64
LEAST_COUNT, LEAST_GAIN = 8, 2.0

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_END = np.uint64(0x5851F42D4C957F2D)
_BLOCKS = "block bigint, n bigint, words bigint, ids array<bigint>, held binary, ends binary, codes binary, hashes binary"
_KINDS = [("block", pa.int64()), ("n", pa.int64()), ("words", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.binary()), ("ends", pa.binary()), ("codes", pa.binary()), ("hashes", pa.binary())]
_ASKED = "block bigint, kind int, bucket int, n int, keys binary, own binary"
_TOLD = "block bigint, kind int, bucket int, told binary, different bigint, total bigint, numbered bigint"
# kinds of questions
WORD, PAIR, TRIPLE, SHORT, LONG = range(5)


def _pack(values: np.ndarray) -> bytes:
    """Small by bytes of one significance side by side."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _unpack(packed: bytes, kind: type, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(size, n).T).view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(packed: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(packed, np.uint64, n), dtype=np.uint64)


def _join(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _parts(joined: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(joined):
        size = int.from_bytes(joined[at:at + 8], "little")
        out.append(joined[at + 8:at + 8 + size])
        at += 8 + size
    return out


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hashes: sorted keys of a block are close together in each, and small as differences."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _key(context: np.ndarray, word: np.ndarray, most: int) -> np.ndarray:
    """An n-gram from the numbers of its context and its last word; a hash of both where ``most`` numbers pass 32 bits."""
    return context << np.uint64(32) | word if most <= 1 << 32 else _mix(context, word)


def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts as codes of different words."""
    task = TaskContext.get().partitionId() << 32
    made = 0
    pending: list[tuple] = []
    size = 0

    def block() -> pa.RecordBatch:
        hashes = np.unique(np.concatenate([p[3] for p in pending]))
        codes = np.concatenate([np.searchsorted(hashes, p[3]).astype(np.int32)[p[2]] for p in pending])
        lengths = np.concatenate([p[4] for p in pending])
        row = [task + made, len(codes), len(hashes), [i for p in pending for i in p[0]], np.concatenate([p[1] for p in pending]).tobytes(), np.cumsum(lengths).tobytes(), _pack(codes), _pack_keys(hashes)]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, (_, k) in zip(row, _KINDS)], [n for n, _ in _KINDS])

    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_buffer(part.column("text"))
            coded, distinct, firsts = words(data, offsets)
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()] + [int(_END)], np.uint64)
            ends = firsts[1:] + np.arange(1, len(firsts))
            codes = np.full(len(coded) + part.num_rows, len(hashes) - 1, np.int64)
            inner = np.ones(len(codes), bool)
            inner[ends - 1] = False
            codes[inner] = coded
            pending.append((part.column("id").to_pylist(), part.column("held").to_numpy(zero_copy_only=False).astype(np.uint8), codes, hashes, np.diff(ends, prepend=0)))
            size += len(codes)
            if size >= BLOCK_TOKENS:
                yield block()
                made, pending, size = made + 1, [], 0
    if pending:
        yield block()


class _Block:
    """One block: its symbols, and what buckets have told about them."""

    def __init__(self, row: dict, buckets: int, least: int):
        self.block, self.ids, self.buckets, self.least = row["block"], row["ids"], buckets, least
        self.held = np.frombuffer(row["held"], np.uint8).astype(bool)
        self.ends = np.frombuffer(row["ends"], np.int64)
        n = int(self.ends[-1])
        self.hashes = _unpack_keys(row["hashes"], row["words"])
        self.codes = _unpack(row["codes"], np.int32, n)
        lengths = np.diff(self.ends, prepend=0)
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.place = (np.arange(n) - np.repeat(self.ends - lengths, lengths)).astype(np.int32)
        self.learned = ~self.held[self.doc]
        self.dealt = np.uint16 if buckets < 1 << 16 else np.int64  # short numbers sort faster
        self.word_to = _bucket(self.hashes, buckets).astype(self.dealt)

    def _ask(self, kind: int, to: np.ndarray, keys: np.ndarray, *own: np.ndarray) -> list[tuple]:
        """Rows of different keys, sorted in each bucket of ``to``, with the block's own figures."""
        return [(self.block, kind, bucket, len(at), _pack_keys(keys[at]), _join(*(_pack(x[at]) for x in own))) for bucket, at in self._dealt(to)]

    def _dealt(self, to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Buckets and the places of their keys."""
        order = np.argsort(to, kind="stable")
        bounds = np.searchsorted(to[order], np.arange(self.buckets + 1))
        for bucket in np.flatnonzero(np.diff(bounds)):
            yield int(bucket), order[bounds[bucket]:bounds[bucket + 1]]

    def _answer(self, told: dict, kind: int, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the buckets told, in the order of the keys that were asked, and the numbers of words that came twice and of pairs that are contexts."""
        out, numbers = np.zeros(len(to), np.uint64), np.zeros(len(to), np.uint64)
        for bucket, at in self._dealt(to):
            parts = _parts(told[kind, bucket])
            out[at] = _unpack(parts[0], np.uint64, len(at))
            if kind in (WORD, PAIR):
                numbered = at[out[at] >> np.uint64(1) >= (2 if kind == WORD else self.least)]
                numbers[numbered] = _unpack_keys(parts[1], len(numbered))
        return out, numbers

    def _grams(self, where: np.ndarray, context: np.ndarray, hashes: np.ndarray, numbers: np.ndarray, to: np.ndarray, size: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
        """Different n-grams at the places: keys, the code of each place, training counts and buckets. Figures of contexts are by their codes."""
        before, word = context[where], self.codes[where]
        keys, codes = np.unique(_key(numbers[before], self.word_numbers[word], most), return_inverse=True)
        codes = codes.astype(np.int32)
        dealt = np.zeros(len(keys), self.dealt)
        dealt[codes] = np.where(size[where] > BUCKET_TOKENS // HOT, _bucket(_mix(hashes[before], self.hashes[word]), self.buckets), to[before])
        return keys, codes, np.bincount(codes[self.learned[where]], minlength=len(keys)).astype(np.uint64), dealt

    def word_questions(self) -> list[tuple]:
        counts = np.bincount(self.codes[self.learned], minlength=len(self.hashes)).astype(np.uint64)
        return self._ask(WORD, self.word_to, self.hashes, counts)

    def hear_words(self, told: dict, total: int, different: int, starts: np.ndarray) -> None:
        """Corpus counts of words; the root's logarithms; pairs whose context came often enough and whose word came twice."""
        self.word_told, self.word_places = self._answer(told, WORD, self.word_to)
        self.word_numbers = self.word_places + starts[self.word_to]
        self.count = (self.word_told >> np.uint64(1)).astype(np.float64)
        self.total, self.different = total, different
        self.root = (self.count + 1) / (total + different + 1)
        self.base = np.log10(self.root[self.codes])
        self.word_before = np.concatenate([np.zeros(1, np.int32), self.codes[:-1]])
        self.word_size = np.where(self.place >= 1, self.count[self.word_before], 0)
        self.with_pair = np.flatnonzero((self.word_size >= self.least) & (self.count[self.codes] >= 2) & (self.place >= 1))
        self.pair_keys, self.pair_codes, self.pair_own, self.pair_to = self._grams(
            self.with_pair, self.word_before, self.hashes, self.word_numbers, self.word_to, self.word_size, int(starts[-1]))

    def pair_questions(self) -> list[tuple]:
        return self._ask(PAIR, self.pair_to, self.pair_keys, self.pair_own)

    def hear_pairs(self, told: dict, starts: np.ndarray) -> None:
        """Corpus counts of pairs; triples whose context came often enough and whose later pair came twice."""
        self.pair_told, self.pair_places = self._answer(told, PAIR, self.pair_to)
        count = (self.pair_told >> np.uint64(1)).astype(np.float64)
        n = len(self.codes)
        self.pair_at = np.zeros(n)
        self.pair_at[self.with_pair] = count[self.pair_codes]
        pair = np.zeros(n, np.int32)
        pair[self.with_pair] = self.pair_codes
        self.pair_before = np.concatenate([pair[:1] * 0, pair[:-1]])
        self.pair_size = np.where(self.place >= 2, np.concatenate([[0.0], self.pair_at[:-1]]), 0)
        self.with_triple = np.flatnonzero((self.pair_size >= self.least) & (self.pair_at >= 2))
        self.triple_keys, self.triple_codes, self.triple_own, self.triple_to = self._grams(
            self.with_triple, self.pair_before, self.pair_keys, self.pair_places + starts[self.pair_to], self.pair_to, self.pair_size, int(starts[-1]))

    def _share(self, asked: np.ndarray, contexts: np.ndarray, where: np.ndarray, codes: np.ndarray, told: np.ndarray, context: np.ndarray, size: np.ndarray, parent: np.ndarray) -> list[np.ndarray]:
        """For each asked context: its count, and three sums over the symbols that followed it at least twice and whose n-gram this block answers for.

        The sums: discounted counts, their gain over the parent, the parent's share. Buckets name one block for each n-gram, the context
        itself included. All are 0, and take no room, where there is nothing to add.
        """
        count = (told >> np.uint64(1)).astype(np.float64)
        first = np.zeros(len(count), np.int64)
        first[codes[::-1]] = where[::-1]
        some = (told & np.uint64(1)).astype(bool) & (count >= 2)
        at, kept = first[some], count[some] - 1
        gain = kept * np.log(kept / size[at] / parent[at])
        place = np.searchsorted(asked, context[at])
        sizes = (contexts[asked] >> np.uint64(1)) * (contexts[asked] & np.uint64(1))
        total = lambda x: np.bincount(place, x, len(asked))
        return [sizes, total(kept).astype(np.uint64), total(gain).astype(np.float32), total(parent[at]).astype(np.float32)]

    def _asked_words(self) -> np.ndarray:
        """Codes of the words that are contexts; nothing follows an end."""
        return np.flatnonzero((self.count >= self.least) & (self.hashes != _END))

    def _asked_pairs(self) -> np.ndarray:
        """Codes of the pairs that are contexts."""
        before = np.zeros(len(self.pair_keys), bool)
        before[self.pair_before[self.pair_size >= self.least]] = True
        return np.flatnonzero(before)

    def short_and_triple_questions(self) -> list[tuple]:
        asked = self._asked_words()
        share = self._share(asked, self.word_told, self.with_pair, self.pair_codes, self.pair_told, self.word_before, self.word_size, self.root[self.codes])
        return self._ask(TRIPLE, self.triple_to, self.triple_keys, self.triple_own) + self._ask(SHORT, self.word_to[asked], self.word_places[asked], *share)

    def _kept(self, told: dict, kind: int, asked: np.ndarray, to: np.ndarray, context: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place: whether its context is kept, and the share of the context that goes to its parent."""
        states = np.zeros(len(to) + 1)  # different symbols that followed, and one; 0 when it is not kept
        states[asked] = self._answer(told, kind, to[asked])[0]
        state = states[np.where(size >= self.least, context, len(to))]
        return state > 0, (state - 1) / np.maximum(size, 1)

    def hear_short_and_triples(self, told: dict) -> None:
        self.triple_told = self._answer(told, TRIPLE, self.triple_to)[0]
        kept, rest = self._kept(told, SHORT, self._asked_words(), self.word_to, self.word_before, self.word_size)
        root = self.root[self.codes]
        self.short = np.where(kept, np.maximum(self.pair_at - 1, 0) / np.maximum(self.word_size, 1) + rest * root, root)
        self.short_kept = kept

    def long_questions(self) -> list[tuple]:
        asked = self._asked_pairs()
        share = self._share(asked, self.pair_told, self.with_triple, self.triple_codes, self.triple_told, self.pair_before, self.pair_size, self.short)
        return self._ask(LONG, self.pair_to[asked], self.pair_places[asked], *share)

    def scores(self, told: dict) -> pa.RecordBatch:
        kept, rest = self._kept(told, LONG, self._asked_pairs(), self.pair_to, self.pair_before, self.pair_size)
        triple = np.zeros(len(self.codes))
        triple[self.with_triple] = (self.triple_told >> np.uint64(1)).astype(np.float64)[self.triple_codes]
        final = np.where(kept, np.maximum(triple - 1, 0) / np.maximum(self.pair_size, 1) + rest * self.short, self.short)
        rows = len(self.ends)
        add = lambda x: np.bincount(self.doc, x, rows)
        learned = bool(self.total)
        depth = np.where(kept, 2, self.short_kept)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids, pa.int64()), pa.array(self.held), pa.array(np.diff(self.ends, prepend=0)), pa.array(add((self.count[self.codes] > 0).astype(float)).astype(np.int64)),
             pa.array(np.full(rows, self.total)), pa.array(add(self.base) * learned), pa.array(add(np.log10(final)) * learned), pa.array(add(depth) / np.diff(self.ends, prepend=0))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "mean_depth"])


def _bucket_answers(least: int, least_gain: float):
    """Sums over all blocks for one bucket, told to each block in the order in which it asked.

    For n-grams: twice the count, and one more for the block that answers for the n-gram; 0 for pairs and triples that came once. For words that came
    twice and pairs that came ``least`` times, their numbers in the bucket as well. For contexts: the number of different symbols that followed, and one, or 0 when it is not kept.
    """
    def answer(asked: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        kinds = asked.column("kind").to_numpy()
        for kind in np.unique(kinds):
            part = asked.filter(pa.array(kinds == kind)).to_pylist()
            keys, place = np.unique(np.concatenate([_unpack_keys(r["keys"], r["n"]) for r in part]), return_inverse=True)
            forms = [np.uint64, np.uint64, np.float32, np.float32] if kind in (SHORT, LONG) else [np.uint64]
            own = [np.concatenate(x) for x in zip(*([_unpack(p, f, r["n"]) for p, f in zip(_parts(r["own"]), forms)] for r in part))]
            if kind in (SHORT, LONG):
                size, kept, gain, share = (np.bincount(place, x, len(keys)) for x in own)
                rest = 1 - kept / np.maximum(size, 1)
                other = np.clip(1 - share, 1e-12, 1)
                gain = gain + size * rest * np.log(np.maximum(rest, 1e-12) / other)
                told = np.where((kept > 0) & (gain >= least_gain), size - kept + 1, 0).astype(np.uint64)[place]
            else:
                total = np.bincount(place, own[0], len(keys)).astype(np.uint64)
                told = np.where((total >= 2) | (kind == WORD), total, 0).astype(np.uint64)[place] << np.uint64(1)
                learned = np.flatnonzero((own[0] > 0) & (told > 0))
                told[learned[np.unique(place[learned], return_index=True)[1]]] += np.uint64(1)
            if kind in (WORD, PAIR):
                numbered = total >= (2 if kind == WORD else least)
                numbers = (np.cumsum(numbered) - 1).astype(np.uint64)
                rows.append((-1, int(kind), part[0]["bucket"], b"", int((total > 0).sum()), int(total.sum()), int(numbered.sum())))
            ends = np.cumsum([r["n"] for r in part])
            for r, a, b in zip(part, [0, *ends[:-1]], ends):
                told_ = [_pack(told[a:b])]
                if kind in (WORD, PAIR):
                    told_.append(_pack_keys(numbers[place[a:b][numbered[place[a:b]]]]))
                rows.append((r["block"], int(kind), r["bucket"], _join(*told_), None, None, None))
        kinds_ = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds_)], [c.split()[0] for c in _TOLD.split(", ")])

    return answer


def _asked_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in _ASKED.split(", ")])


def score_texts(docs: DataFrame, held_out: Column, least_count: int = LEAST_COUNT, least_gain: float = LEAST_GAIN, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, mean_depth`` of every text, by a tree of the texts not held out.

    The tables of blocks and answers are external, in the shared folder; only their names leave the catalog again.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "suffix-tree")
    prefix = f"suffix_{uuid.uuid4().hex}"
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = max(least_count, 2)  # a context that came once is never kept: nothing followed it twice

    def by_block(df: DataFrame, name: str) -> DataFrame:
        """The table with these rows added."""
        writer = df.write.format("parquet").mode("append").bucketBy(parts, "block")
        (writer if spark.catalog.tableExists(f"{prefix}_{name}") else writer.option("path", f"{folder}/{name}")).saveAsTable(f"{prefix}_{name}")
        return spark.table(f"{prefix}_{name}")

    blocks = by_block(rows.mapInArrow(tokenized, _BLOCKS), "blocks")
    tokens = blocks.agg(F.sum("n")).first()[0] or 0
    buckets = max(parts, -(-tokens // BUCKET_TOKENS))

    def answered(asked: DataFrame) -> DataFrame:
        """The answers to all questions so far. A step runs once, so its shuffle files go when it ends."""
        before = spark.conf.get(_CLEAN, "false")
        spark.conf.set(_CLEAN, "true")
        try:
            return by_block(asked.groupBy("bucket").applyInArrow(_bucket_answers(least, least_gain), _TOLD).repartition(parts, "block"), "told")
        finally:
            spark.conf.set(_CLEAN, before)

    def starts_of(told: DataFrame, kind: int) -> np.ndarray:
        """Where the numbers of each bucket begin, and their end: one count a bucket."""
        out = np.zeros(buckets + 1, np.uint64)
        for r in told.filter((F.col("block") == -1) & (F.col("kind") == kind)).select("bucket", "numbered").collect():
            out[r.bucket + 1] = r.numbered
        return np.cumsum(out, dtype=np.uint64)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _asked_table(_Block(row, buckets, least).word_questions()).to_batches()

    told = answered(blocks.mapInArrow(words, _ASKED))
    size = told.filter("block = -1").agg(F.sum("different").alias("v"), F.sum("total").alias("n")).first()
    different, total, starts = size.v or 0, size.n or 0, [starts_of(told, WORD)]

    def block_of(left: pa.Table, right: pa.Table) -> tuple[_Block, dict]:
        answers = {(r["kind"], r["bucket"]): r["told"] for r in right.to_pylist()}
        block = _Block(left.to_pylist()[0], buckets, least)
        block.hear_words(answers, total, different, starts[0])
        return block, answers

    def pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        return _asked_table(block_of(left, right)[0].pair_questions())

    def short_and_triples(left: pa.Table, right: pa.Table) -> pa.Table:
        block, answers = block_of(left, right)
        block.hear_pairs(answers, starts[1])
        return _asked_table(block.short_and_triple_questions())

    def long(left: pa.Table, right: pa.Table) -> pa.Table:
        block, answers = block_of(left, right)
        block.hear_pairs(answers, starts[1])
        block.hear_short_and_triples(answers)
        return _asked_table(block.long_questions())

    def last(left: pa.Table, right: pa.Table) -> pa.Table:
        block, answers = block_of(left, right)
        block.hear_pairs(answers, starts[1])
        block.hear_short_and_triples(answers)
        return pa.Table.from_batches([block.scores(answers)])

    def ask(fn, schema: str) -> DataFrame:
        """Each block with what it has been told; both tables are bucketed by block, so nothing is moved."""
        known = told.filter("block >= 0").select("block", "kind", "bucket", "told")
        return blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(fn, schema)

    told = answered(ask(pairs, _ASKED))
    starts.append(starts_of(told, PAIR))
    told = answered(ask(short_and_triples, _ASKED))
    told = answered(ask(long, _ASKED))
    out = ask(last, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, mean_depth double")
    for name in ("blocks", "told"):
        spark.sql(f"DROP TABLE {prefix}_{name}")
    return out
