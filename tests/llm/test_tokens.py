"""Token files and packing against the tokenizer itself and against exact small packings."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from moodtide.llm import best_fit, token_files, tokens
from moodtide.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY
from tests.llm.conftest import ODD_TEXTS


def encode(path, text, end):
    own = Tokenizer.from_file(path)
    return own.encode(text or "", add_special_tokens=False).ids + [end]


def check_files(spark, docs, rows, folder):
    token_files.write_token_files(docs, folder, WORD_VOCABULARY, end=1)
    read = token_files.read_documents(spark, folder).join(token_files.part_starts(spark, folder), "part").collect()
    got = sorted(((r.start_in_part + r.part_offset, r.doc_id, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in read), key=lambda r: r[0])
    want = sorted((i is not None, i or 0, tuple(encode(WORD_VOCABULARY, t, 1))) for i, t in rows)
    assert sorted((i is not None, i or 0, tuple(ids)) for _, i, _, ids in got) == want
    assert [i or -1 for _, i, _, _ in got] == sorted(i or -1 for i, _ in rows)
    starts = list(itertools.accumulate((n for _, _, n, _ in got), initial=0))
    assert [s for s, _, _, _ in got] == starts[:-1]


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_token_files_round_trip(spark, request, work, table):
    check_files(spark, request.getfixturevalue(table), ODD_TEXTS, work())


def test_token_files_of_nothing(spark, none, work):
    folder = work()
    token_files.write_token_files(none, folder, WORD_VOCABULARY, end=1)
    assert token_files.read_documents(spark, folder).count() == 0


def test_token_files_with_a_trained_dictionary_and_short_access(spark, folder, work):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    at = work()
    check_files(spark, docs, rows, at)
    assert len(spark.read.parquet(f"{at}/dictionary").first().dictionary) > 0
    some = {r.doc_id: r.ids for r in token_files.read_documents(spark, at, only=[3, 17, 10**9]).collect()}
    assert sorted(some) == [3, 17]
    assert np.frombuffer(some[17], "<u4").tolist() == encode(WORD_VOCABULARY, dict(rows)[17], 1)


def test_a_very_long_text_is_whole(spark, work):
    text = " ".join(f"word{i % 977}" for i in range(300_000))
    check_files(spark, spark.createDataFrame([(1, text)], "doc_id bigint, text string"), [(1, text)], work())


def check_packing(spark, docs, rows, capacity, folder):
    placed = best_fit.pack(docs, folder, BYTE_VOCABULARY, end=2, capacity=capacity)
    got = placed.collect()
    want = []
    for doc, text in rows:
        ids = encode(BYTE_VOCABULARY, text, 2)
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        want += [(doc or -1, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == list(itertools.accumulate((n for _, n in parts), initial=0))[:-1]
        assert sum(n for _, n in parts) <= capacity
    made = best_fit.sequences(spark, folder, placed).collect()
    assert {r.sequence_id: r.n_tokens for r in made} == {s: sum(n for _, n in p) for s, p in by.items()}
    assert all(len(r.ids) == 2 * r.n_tokens for r in made)
    return len(by), sum(w[3] for w in want)


@pytest.mark.parametrize("table", ["odd", "clashing"])
@pytest.mark.parametrize("capacity", [4, 7, 1024])
def test_packing(spark, request, work, table, capacity):
    check_packing(spark, request.getfixturevalue(table), ODD_TEXTS, capacity, work())


def test_packing_of_nothing(none, work):
    assert best_fit.pack(none, work(), BYTE_VOCABULARY, end=2).count() == 0


def test_packing_of_a_table_is_tight(spark, folder, work):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    sequences, ids = check_packing(spark, docs, [tuple(r) for r in docs.collect()], 1024, work())
    assert sequences <= 1.02 * ids / 1024 + 1


def fewest(counts, capacity):
    items = sorted((s for s, n in counts.items() for _ in range(n)), reverse=True)
    best = len(items)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for b in {x: k for k, x in enumerate(bins) if x + items[i] <= capacity}.values():
            bins[b] += items[i]
            go(i + 1, bins)
            bins[b] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best


def test_reduction_keeps_an_optimum_and_the_plan_places_all():
    rng = random.Random(5)
    for _ in range(400):
        capacity = rng.choice([10, 12, 20, 30])
        counts = {}
        for _ in range(rng.randint(1, 9)):
            size = rng.randint(1, capacity)
            counts[size] = counts.get(size, 0) + 1
        runs = best_fit.plan(counts, capacity)
        used = {}
        for times, content in runs:
            assert times > 0 and sum(s * k for s, k in content) <= capacity
            for s, k in content:
                used[s] = used.get(s, 0) + times * k
        assert used == counts
        fixed, rest = best_fit.reduce_instance(counts, capacity)
        assert sum(t for t, _ in fixed) + (fewest(rest, capacity) if rest else 0) == fewest(counts, capacity)


def test_the_plan_does_not_depend_on_the_numbers_of_documents():
    counts = {s: 10**9 + s for s in range(1, 1025)}
    assert len(best_fit.plan(counts, 1024)) < 5000


@pytest.mark.parametrize("path", [WORD_VOCABULARY, BYTE_VOCABULARY])
def test_texts_that_spell_added_tokens(path):
    """The library's plain call, for texts with every added token alone, inside words, repeated, in capitals and cut short."""
    added = sorted({t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()})
    forms = [f for t in added for f in (t, f"a {t} b", f"a{t}b", t * 3, f" {t}\n{t} ", t.upper(), t[:-1], t[1:], f"x {t[:5]} {t[5:]}")]
    texts = ["plain", None, *forms, "", "more words, and a stop.", *forms[:2]]
    flat, offsets = tokens.Coder(path).ids(pa.array(texts, pa.string()), 7)
    assert [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [encode(path, t, 7) for t in texts]
