"""Token ids of whole texts with the ``tokenizers`` library, in Arrow batches."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from moodtide.llm.flat import pieces, slices, spread, text_buffer

#: Distinct pieces a worker keeps with their ids; when full the store starts anew, so its memory has a bound.
KEPT_PIECES = 1_200_000
#: Bytes of text that are encoded at a time: the more, the fewer pieces come up again.
ENCODE_BYTES = 16 << 20

_CODERS: dict[str, "Coder"] = {}


class Coder:
    """Encodes texts piece by piece; each distinct piece goes through the tokenizer once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # for the pieces; texts that spell an added token out are encoded whole by the plain one
        for own in (self.tokenizer, self.plain):
            own.no_truncation()
            own.no_padding()
        self.added = sorted({(t.content, t.normalized) for t in self.plain.get_added_tokens_decoder().values()})
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.known: dict[bytes, bytes] = {}

    def ids(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each text closed by ``end``, and the offsets of the texts."""
        texts = pc.fill_null(texts, "")
        odd = np.zeros(len(texts), bool)
        for content, in_any_case in self.added:
            odd |= pc.match_substring(texts, content, ignore_case=in_any_case).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._of_pieces(texts, end)
        flat, offsets = self._of_pieces(pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts), end)
        whole, parts, sizes = {i: self.plain.encode(texts[i].as_py(), add_special_tokens=False).ids for i in np.flatnonzero(odd).tolist()}, [], np.diff(offsets)
        last = 0
        for i, ids in whole.items():  # each stands before the end id that its row has already
            parts += [flat[last:offsets[i]], np.array(ids, self.dtype)]
            last, sizes[i] = offsets[i], sizes[i] + len(ids)
        return np.concatenate([*parts, flat[last:]]), np.concatenate([[0], np.cumsum(sizes)])

    def _of_pieces(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_buffer(texts)
        codes, distinct, firsts = pieces(data, offsets)
        spelled = distinct.to_pylist()
        known = self.known
        stored = [known.get(p) for p in spelled]
        fresh = [i for i, b in enumerate(stored) if b is None]
        if len(known) + len(fresh) > KEPT_PIECES:
            known.clear()
        for at in range(0, len(fresh), 20_000):
            part = fresh[at:at + 20_000]
            coded = self.tokenizer.encode_batch_fast([spelled[i].decode("utf-8", "replace") for i in part], add_special_tokens=False)
            for i, e in zip(part, coded):
                known[spelled[i]] = stored[i] = array(self.code, e.ids).tobytes()
        lengths = np.array([len(b) for b in stored], np.int64) // self.dtype.itemsize
        values = np.frombuffer(b"".join(stored), self.dtype)
        flat, begins = spread(codes, np.cumsum(lengths) - lengths, lengths, values)
        bounds = begins[firsts]  # where each text begins; the last is the end of all
        rows = len(offsets) - 1
        out = np.full(len(flat) + rows, end, self.dtype)
        places = np.ones(len(out), bool)
        places[bounds[1:] + np.arange(rows)] = False
        out[places] = flat
        return out, bounds + np.arange(rows + 1)


def coder(path: str) -> Coder:
    """The worker's coder of a vocabulary file; its store of pieces serves all later tasks of the worker."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def encoded(batches: Iterator[pa.RecordBatch], text: str, path: str, end: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the ids of their texts and the offsets of each row's ids."""
    own = coder(path)
    for batch in batches:
        for part in slices(batch, text, ENCODE_BYTES):
            yield part, *own.ids(part.column(text), end)
