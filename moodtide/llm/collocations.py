"""Collocations by top-order marginalisation: only the longest windows are counted, shorter phrases are their sums.

Each word opens one window of ``longest`` words; its further words are lead columns, padded behind the end of the piece. A phrase of any length is then a prefix
of windows, so one ROLLUP over the columns of the counted windows gives the occurrences of all phrases, all words and each language's total.

Windows are counted in slices of text and travel as packed messages to the bucket of their first two words. A bucket shortens a window to the longest prefix that
occurs ``least`` times, for what is longer can be no candidate; a phrase of two words or more lies in one bucket whole, so its count is final there, and shortening
leaves every sum of a shorter prefix as it was. Words that open many windows are dealt to several buckets by their second word. Buckets are as many as the text
needs; where they are more than a slice should write to, messages go there in steps of ``FAN``.

Defined cases: a null language is ``und``; a null text has no words; repeated rows count as often as they are there; ties of score go to the more frequent, then
to the lesser phrase in byte order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodtide.llm import flat
from moodtide.session import shared_dir

#: Bytes of text whose windows make a bucket.
BUCKET_BYTES = 24 << 20
#: Buckets a slice writes to at once.
FAN = 512
#: Windows a bucket holds unmerged.
_HELD = 1 << 20
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False
_MESSAGE = "bucket int, lang string, salt int, data binary"


def word_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Codes of all words in order, the distinct words, each word's row, and a number that words of one piece share."""
    solid = _WORD[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = solid[begins]
    starts = np.flatnonzero(first)
    place = np.cumsum(solid)[starts] - 1 if len(starts) else starts
    codes, distinct = flat.numbered(flat.LOWER[data[solid]], np.append(place, int(solid.sum())))
    rows = np.searchsorted(offsets, starts, "right") - 1
    return codes.astype(np.int64), distinct, rows, rows + (np.cumsum(_BREAK[data])[starts] if len(starts) else 0)


def windows(codes: np.ndarray, pieces: np.ndarray, longest: int, pad: int) -> list[np.ndarray]:
    """The lead columns: each word and those that follow it in its piece, then ``pad``."""
    out = [codes]
    for k in range(1, longest):
        lead = np.full(len(codes), pad, np.int64)
        same = pieces[k:] == pieces[:-k]
        lead[:max(len(codes) - k, 0)][same] = codes[k:][same]
        out.append(lead)
    return out


def counted(columns: list[np.ndarray], n: np.ndarray, base: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Different windows of codes below ``base`` in order, and the sums of their counts."""
    ids = columns[0]
    for place, column in enumerate(columns[1:], 2):
        _, at, ids = np.unique(ids * base + column, return_index=True, return_inverse=True)
    if len(columns) == 1:
        _, at, ids = np.unique(ids, return_index=True, return_inverse=True)
    return [c[at] for c in columns], np.bincount(ids, n, len(at)).astype(np.int64)


def shortened(columns: list[np.ndarray], n: np.ndarray, pad: int, least: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Windows cut to the longest prefix that occurs ``least`` times, merged again; first words stay in any case."""
    ids, depth = columns[0], np.ones(len(n), np.int64)
    for column in columns[1:]:
        _, ids = np.unique(ids * (pad + 1) + column, return_inverse=True)
        depth += (np.bincount(ids, n)[ids] >= least) & (column != pad)
    return counted([np.where(depth > k, c, pad) for k, c in enumerate(columns)], n, pad + 1)


def packed(columns: list[np.ndarray], n: np.ndarray, words: pa.Array) -> bytes:
    """Windows in order as one message: the words they use, then their columns by planes of bytes, all under zstandard."""
    pad = len(words)
    used = np.zeros(pad + 1, bool)
    for c in columns:
        used[c] = True
    kept = np.flatnonzero(used[:pad])
    new = np.cumsum(used) - 1
    new[pad] = len(kept)
    codes = [new[c] for c in columns]
    codes[0] = np.diff(codes[0], prepend=0)  # in order, so no difference is negative
    data, offsets = flat.text_buffer(words.take(pa.array(kept)))
    planes = [np.ascontiguousarray(a, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for a in (*codes, n, np.diff(offsets))]
    head = np.array([len(columns), len(n), len(kept)], "<u8").tobytes()
    return zstandard.ZstdCompressor(3).compress(b"".join([head, *planes, data.tobytes()]))


def unpacked(message: bytes) -> tuple[list[np.ndarray], np.ndarray, pa.Array]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(message), np.uint8)
    width, rows, kept = raw[:24].view("<u8").tolist()
    arrays, at = [], 24
    for size in [rows] * (width + 1) + [kept]:
        arrays.append(np.ascontiguousarray(raw[at:at + 8 * size].reshape(8, size).T).view("<i8").reshape(-1))
        at += 8 * size
    *codes, n, lengths = arrays
    codes[0] = np.cumsum(codes[0])
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), kept, [None, pa.py_buffer(offsets), pa.py_buffer(raw[at:].copy())])
    return codes, n, words


def merged(messages: list[tuple]) -> tuple[list[np.ndarray], np.ndarray, pa.Array]:
    """Unpacked messages as one, over one vocabulary."""
    if len(messages) == 1:
        return messages[0]
    coded = pa.concat_arrays([m[2] for m in messages]).dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    columns, at = [[] for _ in messages[0][0]], 0
    for own, _, part in messages:
        new = np.append(codes[at:at + len(part)], len(words))
        at += len(part)
        for out, c in zip(columns, own):
            out.append(new[c])
    return *counted([np.concatenate(c) for c in columns], np.concatenate([m[1] for m in messages]), len(words) + 1), words


def _dealt(columns: list[np.ndarray], n: np.ndarray, words: pa.Array, lang: str, buckets: int, width: int) -> Iterator[tuple]:
    """Messages to groups of ``width`` buckets. A first word's windows lie in up to an eighth of the buckets, by the second word."""
    marks = np.array([*map(zlib.crc32, words.to_pylist()), 0], np.int64)
    near = marks[columns[1]] % max(1, buckets // 8) if len(columns) > 1 else 0
    group = ((marks[columns[0]] ^ zlib.crc32(lang.encode())) + near) % buckets // width
    order = np.argsort(group, kind="stable")
    bounds = np.flatnonzero(np.diff(group[order], prepend=-1, append=buckets))
    for a, b in zip(bounds[:-1], bounds[1:]):
        at = order[a:b]
        data = packed([c[at] for c in columns], n[at], words)
        yield int(group[at[0]]), lang, zlib.crc32(data) % 64, data


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], ["bucket", "lang", "salt", "data"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, tuple]]:
    """Merged windows of each bucket and language of a sorted partition. Messages are merged as they come, so only different windows are held."""
    now, held, size = None, [], 0
    for batch in batches:
        for bucket, lang, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "lang", "data"))):
            if (bucket, lang) != now:
                if held:
                    yield now[1], merged(held)
                now, held, size = (bucket, lang), [], 0
            held.append(unpacked(data))
            size += len(held[-1][1])
            if size > _HELD and len(held) > 1:
                held = [merged(held)]
                size = len(held[0][1]) // 2  # so that merging stays in proportion
    if held:
        yield now[1], merged(held)


def counts(docs: DataFrame, longest: int, least: int, lang: str = "lang", text: str = "text", bucket_bytes: int = BUCKET_BYTES, fan: int = FAN) -> DataFrame:
    """``lang, w0, w1, ..., n``: windows shortened to what occurs ``least`` times; an empty word is padding."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    widths = [1]
    while buckets > fan * widths[0]:
        widths.insert(0, fan * widths[0])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.slices(batch, "text"):
                codes, words, at, pieces = word_pieces(*flat.text_buffer(part.column("text")))
                tongues = part.column("lang").dictionary_encode()
                own = tongues.indices.to_numpy(zero_copy_only=False)[at]
                whole = windows(codes, pieces, longest, len(words))
                for i, tongue in enumerate(tongues.dictionary.to_pylist()):
                    here = np.flatnonzero(own == i)
                    if len(here):
                        found = counted([c[here] for c in whole], np.ones(len(here)), len(words) + 1)
                        yield _rows([*_dealt(*found, words, tongue, buckets, widths[0])])

    def onward(width: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for tongue, found in _groups(batches):
                yield _rows([*_dealt(*found, tongue, buckets, width)])
        return run

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tongue, (columns, n, words) in _groups(batches):
            columns, n = shortened(columns, n, len(words), least)
            named = pa.concat_arrays([words, pa.array([b""], pa.large_binary())]).cast(pa.large_string())
            yield pa.RecordBatch.from_arrays([pa.array([tongue] * len(n)), *(named.take(pa.array(c)).cast(pa.string()) for c in columns), pa.array(n)],
                                             ["lang", *(f"w{k}" for k in range(longest)), "n"])

    sent = rows.mapInArrow(cut, _MESSAGE)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for width in widths[1:]:
        sent = sent.repartition(max(parts, fan), "bucket", "salt").sortWithinPartitions("bucket", "lang").mapInArrow(onward(width), _MESSAGE)
    sent = sent.repartition(max(parts, buckets), "bucket").sortWithinPartitions("bucket", "lang")
    return sent.mapInArrow(settle, ", ".join(["lang string", *(f"w{k} string" for k in range(longest)), "n bigint"]))


def phrases(found: DataFrame, longest: int, least: int) -> DataFrame:
    """``lang, size, words, f`` of all phrases that occur ``least`` times, by one ROLLUP; size 0 is the language's total."""
    names = [f"w{k}" for k in range(longest)]
    summed = found.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    size = longest - F.bit_count("level")  # the level has a bit for each column that is summed up
    summed = summed.withColumn("size", size).filter("size >= 0").withColumn("words", F.slice(F.array(*names), 1, F.col("size")))
    whole = (F.col("size") == 0) | ((F.element_at("words", -1) != "") & (F.col("f") >= least))
    return summed.filter(whole).select("lang", "size", "words", "f")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, scale: int = 1_000_000,
                 lang: str = "lang", text: str = "text", **sizes: int) -> DataFrame:
    """The best ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase goes when a longer candidate that contains it has ``share`` percent of its occurrences. A word or phrase of f occurrences is part of at most
    f / ``least`` candidates, so the joins below meet rows of candidates only, never of occurrences.
    """
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession, "collocations")
    counts(docs, longest, least, lang, text, **sizes).write.parquet(f"{folder}/windows")
    phrases(spark.read.parquet(f"{folder}/windows"), longest, least).write.parquet(f"{folder}/phrases")
    known = spark.read.parquet(f"{folder}/phrases").withColumn("phrase", F.array_join("words", " "))
    candidates = known.filter("size > 1").withColumnRenamed("f", "a")
    sub = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice("words", i, n), " "))))
    inside = candidates.filter("size > 2").select("lang", F.explode(F.array_distinct(sub)).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(inside, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    cut = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("words", 1, k), " ").alias("left"), F.array_join(F.slice("words", k + 1, F.col("size") - k), " ").alias("right")))
    cuts = kept.select("lang", "phrase", "a", F.explode(cut).alias("cut")).select("lang", "phrase", "a", "cut.*")
    of = lambda side, name: known.filter("size > 0").select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
    cuts = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    whole = {c: f"cast({c} as decimal(15, 0))" for c in "alr"}
    cuts = cuts.withColumn("score", F.expr(f"({whole['a']} * {whole['a']} * cast({scale} as decimal(8, 0))) div ({whole['l']} * {whole['r']})"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.*")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("bigint")).filter(F.col("rank") <= top)
    totals = known.filter("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
