"""Spelling variants by blocked Gram matrices: words one edit apart, and the form and root each goes back to.

Words lie in cells by how many of their letters belong to each of a few classes of letters. One edit moves a word at most one step from its cell (a letter more in
one class, or one class's letter for another's), so only a cell and its neighbours meet, each pair of them once. A cell's words have one length; they are cut into
tiles by hash. For a pair of tiles, the product of their letter-count matrices gives all squared distances at once: a replaced letter makes it two, an added one
makes it one. Pairs at these distances are verified letter by letter. The classes grow in number with the vocabulary, which keeps cells small; they decide work,
never rows.

Defined cases: a null text has no words; a null id is read as an empty one where runs are altered; repeated rows count as often as they are there; without near words
``n_near`` is 0 and the root is the word; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.llm import flat
from moodtide.session import shared_dir

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
#: Words of a tile; fewer where they are long.
TILE = 1024
TILE_LETTERS = 1 << 20
#: Words for which another class of letters is added, each time three times as many.
FIRST_CLASSES = 9000
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_COLUMN = np.zeros(256, np.int64)
_COLUMN[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of all runs of letters with A-Z lowered, the distinct runs, and each run's row. U+00C0 to U+00FF are two bytes that begin with C3."""
    solid = _LETTER[data] | (data == 0xC3)
    solid[1:] |= data[:-1] == 0xC3
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = solid[begins]
    starts = np.flatnonzero(first)
    place = np.cumsum(solid)[starts] - 1 if len(starts) else starts
    codes, distinct = flat.numbered(flat.LOWER[data[solid]], np.append(place, int(solid.sum())))
    return codes.astype(np.int64), distinct, np.searchsorted(offsets, starts, "right") - 1


def word_counts(docs: DataFrame, every: int | None = None, least_letters: int = 6, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of all runs of letters. Of runs whose checksum with the id is a multiple of ``every``, one letter is deleted first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.slices(batch, "text"):
                codes, words, rows = letter_runs(*flat.text_buffer(part.column("text")))
                times = np.bincount(codes, minlength=len(words))
                altered: Counter[str] = Counter()
                if every:
                    met, n = np.unique(rows * max(len(words), 1) + codes, return_counts=True)
                    own, code = np.divmod(met, max(len(words), 1))
                    begins = [zlib.crc32(f"{i or ''}:".encode()) for i in part.column("id").to_pylist()]
                    spelled, crc = words.to_pylist(), zlib.crc32
                    marks = np.array([crc(spelled[c], begins[r]) for r, c in zip(own.tolist(), code.tolist())], np.int64)
                    for i in np.flatnonzero(marks % every == 0).tolist():
                        word, times_here = spelled[code[i]].decode(), int(n[i])
                        at = int(marks[i]) % len(word)
                        altered[word[:at] + word[at + 1:]] += times_here
                        times[code[i]] -= times_here
                named = words.cast(pa.large_string())
                long = np.flatnonzero((times > 0) & (pc.utf8_length(named).to_numpy(zero_copy_only=False) >= least_letters))
                more = {w: k for w, k in altered.items() if len(w) >= least_letters}
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([named.take(pa.array(long)).cast(pa.string()), pa.array(list(more), pa.string())]),
                    pa.concat_arrays([pa.array(times[long], pa.int64()), pa.array(list(more.values()), pa.int64())])], ["word", "n"])

    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _spelled(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letters; every letter has a code below 256."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _letter_counts(spelled: np.ndarray) -> np.ndarray:
    rows = np.arange(len(spelled))[:, None] * len(LETTERS)
    return np.bincount((rows + _COLUMN[spelled]).ravel(), minlength=len(spelled) * len(LETTERS)).reshape(len(spelled), -1).astype(np.float32)


def near_pairs(left: list[str], right: list[str], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of words one edit apart. ``right`` holds words as long as those of ``left`` or one letter longer; ``same`` says that both are one tile."""
    x, y = _spelled(left), _spelled(right)
    size = x.shape[1]
    kind = np.float32 if 2 * (size + 1) ** 2 < 1 << 24 else np.float64  # sums of two squares below 2 ** 24 are exact in the short form
    a, b = _letter_counts(x).astype(kind, copy=False), _letter_counts(y).astype(kind, copy=False)
    longer = y.shape[1] > size
    away = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    i, j = np.nonzero(away == (1 if longer else 2))
    if same:
        i, j = i[i < j], j[i < j]
    kept = []
    for at in range(0, len(i), most := max(1, (1 << 24) // size)):
        p, q = x[i[at:at + most]], y[j[at:at + most]]
        if longer:
            before = np.cumprod(p == q[:, :-1], 1).sum(1)
            after = np.cumprod((p == q[:, 1:])[:, ::-1], 1).sum(1)
            kept.append(before + after >= size)
        else:
            kept.append((p != q).sum(1) == 1)
    right_ones = np.concatenate(kept) if kept else np.zeros(0, bool)
    return i[right_ones], j[right_ones]


def near_words(words: DataFrame, classes: int | None = None, tile: int = TILE) -> DataFrame:
    """``word, n, other, other_n``, both ways round, for all words of ``words`` (``word, n``, each once, all letters in ``LETTERS``) that are one edit apart."""
    spark, folder = words.sparkSession, shared_dir(words.sparkSession, "spelling")
    classes = classes or max(2, 1 + math.ceil(math.log(max(1, words.count()) / FIRST_CLASSES, 3)))
    count = lambda j: F.length("word") - F.length(F.translate("word", LETTERS[j::classes], ""))
    placed = words.select("word", "n", F.array(*[count(j) for j in range(classes)]).alias("cell"), F.length("word").alias("size"))
    most = F.greatest(F.lit(1), F.least(F.lit(tile), F.floor(F.lit(TILE_LETTERS) / F.first("size")).cast("int")))
    placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("tiles")).write.parquet(f"{folder}/cells")
    cells = spark.read.parquet(f"{folder}/cells")
    dealt = placed.join(cells, "cell").withColumn("tile", F.pmod(F.xxhash64("word"), "tiles").cast("int"))
    dealt.groupBy("cell", "tile").agg(F.collect_list(F.struct("word", "n")).alias("words")).write.parquet(f"{folder}/tiles")
    tiles = spark.read.parquet(f"{folder}/tiles")
    step = lambda **at: F.array(*[F.lit(at.get(f"c{j}", 0)) for j in range(classes)])
    steps = [step(), *(step(**{f"c{j}": 1}) for j in range(classes)), *(step(**{f"c{i}": -1, f"c{j}": 1}) for i, j in combinations(range(classes), 2))]
    around = cells.select("cell", "tiles", F.explode(F.array(*steps)).alias("step"))
    around = around.withColumn("beside", F.zip_with("cell", "step", lambda a, b: a + b)).join(cells.select(F.col("cell").alias("beside"), F.col("tiles").alias("tiles_beside")), "beside")
    alike = F.col("cell") == F.col("beside")
    pairs = around.select("cell", "beside", "tiles_beside", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    pairs = pairs.select("cell", "tile", "beside", F.explode(F.sequence(F.when(alike, F.col("tile")).otherwise(F.lit(0)), F.col("tiles_beside") - 1)).alias("tile_beside"))
    met = pairs.join(tiles, ["cell", "tile"]).join(
        tiles.select(F.col("cell").alias("beside"), F.col("tile").alias("tile_beside"), F.col("words").alias("words_beside")), ["beside", "tile_beside"])
    met = met.select("words", "words_beside", (alike & (F.col("tile") == F.col("tile_beside"))).alias("same"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                left, right = (batch.column(c)[row].values for c in ("words", "words_beside"))
                (a, m), (b, n) = ((s.field("word"), s.field("n")) for s in (left, right))
                i, j = map(pa.array, near_pairs(a.to_pylist(), b.to_pylist(), batch.column("same")[row].as_py()))
                ends = [(a.take(i), b.take(j)), (m.take(i), n.take(j)), (b.take(j), a.take(i)), (n.take(j), m.take(i))]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(e) for e in ends], ["word", "n", "other", "other_n"])

    # the pairs are small and their work is large: they are dealt evenly, a few to a task
    return met.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(run, "word string, n bigint, other string, other_n bigint")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of all rows ``word, form``, by pointers over doubled distances. A form is several times as frequent as its word, so there are no rings."""
    spark, now = forms.sparkSession, forms.select("word", F.col("form").alias("root"))
    while True:
        folder = shared_dir(spark, "roots")
        now.write.parquet(folder)
        now = spark.read.parquet(folder)
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = now.join(on, "root")
        if joined.isEmpty():
            return now
        now = now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, every: int | None = None, least_letters: int = 6, least: int = 5, factor: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n``: the form is the most frequent near word (the least of ties) if it is ``factor`` times as frequent."""
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession, "words")
    word_counts(docs, every, least_letters, doc_id, text).filter(F.col("n") >= least).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    best = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    best.write.parquet(f"{folder}/near")
    known = words.join(spark.read.parquet(f"{folder}/near"), "word", "left")
    far = -F.col("best.less") >= factor * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(far, F.col("best.other")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n"))
    last = roots(known.filter(F.col("form").isNotNull()).select("word", "form"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
