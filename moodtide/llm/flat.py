"""Words and tokenizer pieces of Arrow text batches, found on the flat byte buffer of a batch.

A batch of texts is one byte buffer with row offsets. Cutting it into words by numpy masks and letting Arrow number the
distinct ones costs a few nanoseconds a byte, and the slow work of an operator (hashing, encoding, kernels) is then done
once for each distinct word of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; a longer single text is worked on alone and whole.
SLICE_BYTES = 8 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = True
_LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?|"]] = True


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its row offsets; a null is an empty text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text each, so that work memory has a bound."""
    if not batch.num_rows:
        return
    offsets = text_buffer(batch.column(column))[1]
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def numbered(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Code of each piece ``data[offsets[i]:offsets[i + 1]]`` and the distinct pieces."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    coded = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: their codes in text order, the distinct words, and each row's first word (one more at the end)."""
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = solid[begins]
    starts = np.flatnonzero(first)
    kept = data[solid]
    if lower:
        kept = LOWER[kept]
    place = np.cumsum(solid)[starts] - 1 if len(starts) else starts
    codes, distinct = numbered(kept, np.append(place, len(kept)))
    return codes, distinct, np.searchsorted(starts, offsets)


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Texts cut where a pre-tokenizer cuts in any case; codes, distinct pieces, first piece of each row (one more at the end).

    A cut stands before white space that follows another sign, and before a stop that follows an ASCII letter. A tokenizer
    that splits words from white space and from punctuation encodes the pieces alone to the ids of the whole. After bytes that
    may end a wider kind of white space there is no cut: longer pieces are always right.
    """
    n = len(data)
    cut = np.zeros(n, bool)
    if n:
        space, before = SPACE[data], data[:-1]
        cut[1:] = space[1:] & ~space[:-1] & ~((before >= 0x1C) & (before <= 0x1F))
        cut[1:] |= _STOP[data[1:]] & _LETTER[before]
        if n > 3:
            wide = cut[3:] & (data[2:-1] >= 0x80)
            two, three = data[1:-2], data[:-3]
            odd = (two == 0xC2) | ((three == 0xE1) & (two == 0x9A)) | ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE3) & (two == 0x80))
            cut[3:] &= ~(wide & odd)
        cut[1:3] &= data[:min(2, n - 1)] < 0x80
        cut[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(cut)
    codes, distinct = numbered(data, np.append(starts, n))
    return codes, distinct, np.searchsorted(starts, offsets)


def spread(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of each code one after the other (those of code c are ``values[starts[c]:starts[c] + lengths[c]]``), and where each begins."""
    sizes = lengths[codes]
    ends = np.cumsum(sizes)
    begins = ends - sizes
    total = int(ends[-1]) if len(ends) else 0
    index = np.arange(total) + np.repeat(starts[codes] - begins, sizes)
    return values[index], np.append(begins, total)
