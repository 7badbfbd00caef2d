"""Toxicity by a support vector machine over a gap-weighted subsequence kernel with Nystroem landmarks.

A word is the set of its three-letter subsequences, each weighted by ``DECAY`` to the power of the stretch it covers, up to ``SPAN`` letters. So a letter put
into a word, or left out, weakens a match and does not undo it. The kernel of two words is the product of these vectors, scaled by their
lengths. Landmarks are words that tell the labelled classes apart. As Nystroem features are linear in the subsequences, a fitted machine
folds into one table with a weight for each subsequence, and scoring a word costs a few look-ups.

A sentence has the margin of its worst word, a document that of its worst sentence. Labels mark documents, so training goes in rounds: the machine picks
the worst word of the worst sentence of each labelled document, those of toxic documents are examples for, those of the others examples
against (the words that were hardest to tell), and the machine is fitted anew. A logistic curve over the largest margin and the number of sentences with a
positive one gives the score.

Signs that are neither letters nor digits are taken out before words are cut (``st.up-id`` is ``stupid``), and three or more single letters in a row are one
word. Training sees at most ``sample`` labelled documents, those with the smallest hashes of their ids; scoring reads every whole text.

Defined cases: a null or empty text has no sentence and a low margin; repeated rows are scored one by one; an id with several labels
counts as toxic when one of them says so; null ids and labels are not learned from; with no labels or one class only the score is that share (0 without any);
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.flat import numbered, slices, text_buffer
from moodtide.session import shared_dir

#: Bytes of text worked on at a time: reading sentences takes some fifty times as much work memory.
SLICE = 2 << 20
SAMPLE = 20_000
LANDMARKS = 160
DECAY = 0.5
SPAN = 5
#: A sentence longer than this many words is cut.
SENTENCE = 16

_GAPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_START, _END = 1, 2  # classes of a word's ends; letters, a digit class and the bytes of other scripts follow
_CLASS = np.zeros(256, np.int32)
_CLASS[97:123] = _CLASS[65:91] = np.arange(3, 29)
_CLASS[48:58] = 29
_CLASS[0x80:0xC0] = np.arange(30, 94)
_CLASS[0xC2:0xF5] = np.minimum(np.arange(94, 145), 127)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord("!"), ord("?")]] = True
TABLE = 1 << 21


def sentences(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Word codes in text order, the distinct words, each sentence's first word, and each row's first sentence (the last two with an end)."""
    data, offsets = text_buffer(texts)
    n = len(data)
    blank = _BLANK[data]
    letter = _CLASS[data] > 0
    ends = data == 0x0A
    ends[:-1] |= _STOP[data[:-1]] & blank[1:]
    keep = letter | blank
    place = np.concatenate([[0], np.cumsum(keep)])
    sentence_at = np.cumsum(ends)[keep]
    kept = data[keep]
    solid = letter[keep]
    kept[(kept >= 65) & (kept <= 90)] += 32
    rows = place[offsets]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = rows[:-1][rows[:-1] < rows[1:]]
    first[begins] = solid[begins]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.int32), pa.array([], pa.large_binary()), np.zeros(1, np.int64), np.zeros(len(offsets), np.int64)
    sizes = np.diff(np.append(np.cumsum(solid)[starts] - 1, solid.sum()))
    row_of = np.searchsorted(rows, starts, "right") - 1
    # runs of three or more single letters are one word
    single = sizes == 1
    joined = np.zeros(len(starts), bool)
    joined[1:] = single[1:] & single[:-1] & (row_of[1:] == row_of[:-1])
    head = np.flatnonzero(~joined)
    run = np.diff(np.append(head, len(starts)))
    head_of = np.repeat(np.arange(len(head)), run)
    joined &= run[head_of] >= 3
    real = np.flatnonzero(~joined)
    letters = kept[solid]
    codes, distinct = numbered(letters, np.append((np.cumsum(solid)[starts] - 1)[real], len(letters)))
    sentence, row = sentence_at[starts[real]], row_of[real]
    new = np.ones(len(real), bool)
    new[1:] = (sentence[1:] != sentence[:-1]) | (row[1:] != row[:-1])
    base = np.flatnonzero(new)
    inside = np.arange(len(real)) - np.repeat(base, np.diff(np.append(base, len(real))))
    new |= inside % SENTENCE == 0
    bounds = np.flatnonzero(new)
    return codes, distinct, np.append(bounds, len(real)), np.searchsorted(row[bounds], np.arange(len(offsets)))


def _classes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all words one after the other, with a start and an end for each, and the word of each place."""
    data, offsets = text_buffer(words)
    sizes = np.diff(offsets)
    word = np.repeat(np.arange(len(sizes)), sizes + 2)
    out = np.zeros(len(word), np.int32)
    firsts = offsets[:-1] + 2 * np.arange(len(sizes))
    body = np.ones(len(word), bool)
    body[firsts] = body[firsts + sizes + 1] = False
    out[firsts], out[firsts + sizes + 1] = _START, _END
    out[body] = _CLASS[data]
    return out, word


def subsequences(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of gaps: the word and the index of every subsequence with these gaps, and its weight."""
    classes, word = _classes(words)
    for a, b in _GAPS:
        if len(classes) <= b:
            continue
        same = word[:-b] == word[b:]
        index = (classes[:-b] << 14) | (classes[a:a - b] << 7) | classes[b:]
        yield word[:-b][same], index[same], DECAY ** (b + 1)


def word_scores(words: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of a word's subsequences, scaled to a vector of length one."""
    total, norm = np.zeros(len(words)), np.zeros(len(words))
    for word, index, weight in subsequences(words):
        total += weight * np.bincount(word, weights[index], len(words))
        norm += weight ** 2 * np.bincount(word, minlength=len(words))
    return total / np.sqrt(np.maximum(norm, 1e-12))


@dataclass
class Landmarks:
    """Landmark words as rows over the subsequences that any of them has."""

    place: np.ndarray  # of a subsequence among the rows; 0 is none
    rows: np.ndarray   # subsequences x landmarks
    map_: np.ndarray   # kernel values to Nystroem features

    @classmethod
    def of(cls, words: list[bytes]) -> "Landmarks":
        column = pa.array(words, pa.large_binary())
        parts = list(subsequences(column))
        used = np.unique(np.concatenate([i for _, i, _ in parts]))
        place = np.zeros(TABLE, np.int32)
        place[used] = np.arange(1, len(used) + 1)
        rows, norm = np.zeros((len(used) + 1, len(words))), np.zeros(len(words))
        for word, index, weight in parts:
            np.add.at(rows, (place[index], word), weight)
            norm += weight ** 2 * np.bincount(word, minlength=len(words))
        rows /= np.sqrt(norm)
        values, vectors = np.linalg.eigh(rows.T @ rows)
        map_ = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
        return cls(place, rows.astype(np.float32), map_)

    def kernels(self, words: pa.Array) -> np.ndarray:
        """Words x landmarks."""
        out, norm = np.zeros((len(words), self.rows.shape[1]), np.float32), np.zeros(len(words))
        for word, index, weight in subsequences(words):
            norm += weight ** 2 * np.bincount(word, minlength=len(words))
            at = self.place[index]
            word, at = word[at > 0], at[at > 0]
            for lo in range(0, len(at), 1 << 14):
                w = word[lo:lo + (1 << 14)]
                heads = np.flatnonzero(np.diff(w, prepend=-1))
                if len(heads):
                    out[w[heads]] += weight * np.add.reduceat(self.rows[at[lo:lo + (1 << 14)]], heads, axis=0)
        return out / np.sqrt(np.maximum(norm, 1e-12))[:, None].astype(np.float32)

    def weights(self, direction: np.ndarray) -> np.ndarray:
        """A direction among the features, as a weight for each subsequence."""
        table = np.zeros(TABLE, np.float32)
        used = np.flatnonzero(self.place)
        table[used] = (self.rows @ (self.map_ @ direction))[self.place[used]]
        return table


def fit_machine(x: np.ndarray, y: np.ndarray, n: np.ndarray, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine over rows that stand for ``n`` examples each, by Newton steps; both classes weigh alike. Deterministic."""
    x1 = np.column_stack([x, np.ones(len(x))])
    sign = np.where(y, 1.0, -1.0)
    weight = cost * n * np.where(y, 1 / max(1, n[y].sum()), 1 / max(1, n[~y].sum())) * min(1000, n.sum())
    w = np.zeros(x1.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    loss = lambda v: 0.5 * v @ ridge @ v + (weight * np.maximum(0, 1 - sign * (x1 @ v)) ** 2).sum()
    for _ in range(50):
        gap = 1 - sign * (x1 @ w)
        on = gap > 0
        gradient = ridge @ w - 2 * (x1[on].T @ (weight[on] * sign[on] * gap[on]))
        step = np.linalg.solve(ridge + 2 * (x1[on].T * weight[on]) @ x1[on], gradient)
        size, now = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(step).max() * size < 1e-6:
            break
    return w[:-1], float(w[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and constant of a logistic curve with smoothed targets, as Platt has them."""
    p, n = y.sum(), (~y).sum()
    target = np.where(y, (p + 1) / (p + 2), 1 / (n + 2))
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    for _ in range(200):
        q = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1.T * (q * (1 - q) + 1e-9)) @ x1 + 1e-3 * np.eye(len(w)), x1.T @ (q - target) + 1e-3 * w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


#: Margin of a text without a word.
NO_WORD = -2.0


@dataclass
class Model:
    """One weight for each subsequence, a bias, and the curve from a text's evidence to its score."""

    table: np.ndarray
    bias: float
    curve: np.ndarray

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """Largest margin of each text, and the logarithm of the number of its positive sentences and one."""
        codes, distinct, bounds, firsts = sentences(texts)
        out = np.zeros((len(texts), 2))
        out[:, 0] = NO_WORD
        if len(codes):
            margin = np.maximum.reduceat((word_scores(distinct, self.table) + self.bias)[codes], bounds[:-1])
            some = np.flatnonzero(firsts[:-1] < firsts[1:])
            out[some, 0] = np.maximum(np.maximum.reduceat(margin, firsts[some]), NO_WORD)
            out[some, 1] = np.log1p(np.add.reduceat(margin > 0, firsts[some], dtype=np.int64))
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(texts) @ self.curve[:2] + self.curve[2], -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is never learned from; a null id has none and is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sampled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``text, toxic`` of the sample, written once; its ids, at most ``sample``, are broadcast."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna().filter(~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(known), "id")
    folder = shared_dir(docs.sparkSession, "labelled")
    rows.select("text", (F.col("toxic") > 0).alias("toxic")).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def _telling_words(rows: DataFrame, toxic: int, other: int) -> list[tuple[bytes, bool, int, bool]]:
    """Words, their class, the number of its documents, and whether the other class has none: the ``toxic`` words that tell toxic documents best, and the
    ``other`` most common ones of the rest."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                codes, distinct, bounds, firsts = sentences(part.column("text"))
                row = np.repeat(np.arange(part.num_rows), np.diff(bounds[firsts]))
                pairs = np.unique(row * (len(distinct) + 1) + codes)
                word, bad = pairs % (len(distinct) + 1), part.column("toxic").to_numpy(zero_copy_only=False)[pairs // (len(distinct) + 1)]
                for flag in (False, True):
                    n = np.bincount(word[bad == flag], minlength=len(distinct))
                    some = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([distinct.take(pa.array(some)).cast(pa.binary()), pa.array(np.full(len(some), flag)), pa.array(n[some])], ["word", "toxic", "n"])

    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    p, n = sizes.get(True, 0), sizes.get(False, 0)
    if not p or not n:
        return []
    words = rows.mapInArrow(count, "word binary, toxic boolean, n bigint").groupBy("word").agg(
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("p"), F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n"))).alias("n"))
    folder = shared_dir(rows.sparkSession, "words")
    words.filter(F.length("word") >= 3).write.parquet(folder)
    words = rows.sparkSession.read.parquet(folder)
    part = lambda seen, all_, rate: seen * F.log((seen + 0.5) / (all_ * rate + 0.5))
    rate = (F.col("p") + F.col("n")) / float(p + n)
    words = words.withColumn("gain", part(F.col("p"), float(p), rate) + part(F.col("n"), float(n), rate))
    likelier = F.col("p") * float(n) > F.col("n") * float(p)
    worst = words.filter(likelier & (F.col("p") >= 2)).orderBy(F.desc("gain"), "word").limit(toxic).collect()
    common = words.filter(~likelier).orderBy(F.desc("n"), "word").limit(other).collect()
    return [(bytes(r.word), True, r.p, not r.n) for r in worst] + [(bytes(r.word), False, r.n, not r.p) for r in common]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, rounds: int = 5) -> Model:
    rows = _sampled(docs, labels, sample)
    told = _telling_words(rows, landmarks * 3 // 4, 10 * landmarks)
    if not any(t for _, t, _, _ in told):
        share = rows.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
        return Model(np.zeros(TABLE, np.float32), 0.0, np.array([0.0, 0.0, np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -30, 30)]))
    bad, common = [w for w, t, _, _ in told if t], [w for w, t, _, _ in told if not t]
    marks = Landmarks.of(bad + common[:landmarks - len(bad)])
    examples: dict[tuple[bytes, bool], int] = {(w, t): n for w, t, n, _ in told}
    sure = {(w, t): n for w, t, n, alone in told if not t or alone and n > 2}  # stay examples in every round
    machine = None
    for step in range(rounds + 1):
        words = sorted(examples)
        x = marks.kernels(pa.array([w for w, _ in words], pa.large_binary())) @ marks.map_
        direction, bias = fit_machine(x, np.array([t for _, t in words]), np.array([examples[k] for k in words], float))
        machine = Model(marks.weights(direction), bias, np.zeros(3))
        if step == rounds:
            break
        now = machine

        def worst(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text", SLICE):
                    codes, distinct, bounds, firsts = sentences(part.column("text"))
                    value = word_scores(distinct, now.table)[codes]
                    begin = bounds[firsts]
                    some = [(r, a + int(np.argmax(value[a:b]))) for r, (a, b) in enumerate(zip(begin[:-1], begin[1:])) if a < b]
                    words = distinct.take(pa.array(codes[[i for _, i in some]] if some else [], pa.int32())).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([words, part.column("toxic").take(pa.array([r for r, _ in some], pa.int32()))], ["word", "toxic"])

        found = rows.select("text", "toxic").mapInArrow(worst, "word binary, toxic boolean").groupBy("word", "toxic").agg(F.count(F.lit(1)).alias("n"))
        mined = {(bytes(r.word), r.toxic): r.n for r in found.collect()}  # one word for each document of the sample at most
        clean = {w for w, t in mined if not t}
        examples = sure | {k: n for k, n in examples.items() if not k[1]}
        for (word, toxic), n in mined.items():
            if not toxic or word not in clean:
                examples[word, toxic] = examples.get((word, toxic), 0) + n
    fitted = machine

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                seen = fitted.evidence(part.column("text"))
                yield pa.RecordBatch.from_arrays([pa.array(seen[:, 0]), pa.array(seen[:, 1]), part.column("toxic")], ["margin", "many", "toxic"])

    seen = rows.select("text", "toxic").mapInArrow(evidence, "margin double, many double, toxic boolean").toArrow()
    margin, many, y = (seen.column(c).to_numpy() for c in ("margin", "many", "toxic"))
    order = np.lexsort((y, many, margin))  # the same sums in any order of tasks
    return Model(machine.table, machine.bias, fit_logistic(np.column_stack([margin, many])[order], y[order]))


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each text in column ``name``, which replaces one of that name. The model goes to the executors once; its size is fixed."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE):
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(shared.value.scores(part.column(text)))], [*keep, name])

    from pyspark.sql.types import DoubleType, StructType

    return docs.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, StructType([docs.schema[c] for c in keep]).add(name, DoubleType()))
