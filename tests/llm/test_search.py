"""Top k, SimHash and components against brute force."""

import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from moodtide.llm import components, simhash, top_k
from tests.llm.conftest import ODD_TEXTS


def brute_top(rows, is_query, k):
    out = []
    for q, x in rows.items():
        if is_query(q):
            scores = sorted((-sum(int(a) * int(b) for a, b in zip(x, y)), c) for c, y in rows.items() if c != q and len(y) == len(x))
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows, k=5, every=3, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, id string, v int, block int")
    return sorted(map(tuple, top_k.top_k(df, F.col("id") % every == 0, k=k).collect()))


@pytest.mark.parametrize("scale, kind", [(1.0, "float"), (1e4, "double"), (1e6, "double")])
def test_top_k_is_exact(spark, monkeypatch, scale, kind):
    monkeypatch.setattr(top_k, "BLOCK_ROWS", 60)
    monkeypatch.setattr(top_k, "QUERY_ROWS", 16)
    monkeypatch.setattr(top_k, "CONTENDERS", 6)
    rng = np.random.default_rng(1)
    xs = (rng.normal(size=(200, 9)) * scale).astype("f4" if kind == "float" else "f8")
    xs[50:90] = xs[50]  # ties
    rows = [(i, x.tolist(), "e", 1, 2) for i, x in enumerate(xs)]
    want = {i: np.floor(x.astype(float) * 256).astype(np.int64).tolist() for i, x in enumerate(xs)}
    assert found(spark, rows, kind=kind) == brute_top(want, lambda i: i % 3 == 0, 5)


def test_top_k_of_odd_vectors(spark):
    good = [0.5, -0.25, 1.0]
    rows = [(0, good), (3, good), (4, None), (5, [0.1, None, 0.2]), (6, [float("nan"), 1.0, 1.0]), (7, [float("inf"), 1.0, 1.0]), (None, good), (9, [0.0, 0.0, 0.0]),
            (9, [0.0, 0.0, 0.0]), (12, [1.0]), (15, []), (18, [0.5, 0.5])]
    rows = [(i, v, None, None, None) for i, v in rows]
    want = {0: [128, -64, 256], 3: [128, -64, 256], 9: [0, 0, 0], 12: [256], 15: [], 18: [128, 128]}
    assert found(spark, rows) == brute_top(want, lambda i: i % 3 == 0, 5)
    assert found(spark, rows[:0]) == []


def test_top_k_of_a_block_costs_little():
    """Bounds of all pairs of a block take matrix products: less time than three plain products of whole numbers."""
    rng = np.random.default_rng(5)
    xs = np.floor(256 * rng.normal(size=(4096, 64)) / 8).astype(np.int64)
    xs[1000:1900] = xs[:900] + rng.integers(0, 2, (900, 64))  # near copies, and ties
    xs[3000:3100] = xs[:100]
    ids, at = rng.permutation(100_000)[:4096] - 50_000, np.arange(0, 4096, 8)

    def seconds(fn):
        begin = time.thread_time()
        return fn(), time.thread_time() - begin

    got, spent = min((seconds(lambda: top_k.nearest(ids, xs, ids[at], xs[at], 5)) for _ in range(3)), key=lambda x: x[1])
    scores, plain = min((seconds(lambda: xs[at] @ xs.T) for _ in range(3)), key=lambda x: x[1])
    scores[np.arange(len(at)), at] = -1 << 60
    want = [(ids[q], ids[i], row[i]) for q, row in zip(at, scores) for i in np.lexsort((ids, -row))[:5]]
    assert sorted(got) == sorted(want)
    assert spent < 3 * plain


def naive_fingerprint(text, size):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(marks, radius):
    root = {m: m for m in marks}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    marks = sorted(root)
    for i, a in enumerate(marks):
        for b in marks[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {m: find(m) for m in marks}


def check_simhash(docs, rows, size):
    got = simhash.near_duplicates(docs, words=size, radius=3).collect()
    marks = {(i, t): naive_fingerprint(t, size) for i, t in rows}
    root = naive_components(set(marks.values()), 3)
    first = {}
    for (i, _), m in marks.items():
        if i is not None:
            first[root[m]] = min(first.get(root[m], i), i)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    key = lambda r: tuple(-1 if x is None else x for x in r)
    want = sorted(((i, signed(marks[i, t]), first.get(root[marks[i, t]])) for i, t in rows), key=key)
    assert sorted(((r.id, r.fp, r.component_id) for r in got), key=key) == want


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_simhash_of_odd_texts(request, table):
    check_simhash(request.getfixturevalue(table), ODD_TEXTS, 3)


def test_simhash_of_a_table(spark, folder, none):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    check_simhash(docs, [(r.doc_id, r.text) for r in docs.collect()], 3)
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("tile", [4096, 4])
def test_links_connect_what_the_radius_connects(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    marks = set()
    for b in base:  # chains in which each step flips two bits
        m = int(b)
        for _ in range(6):
            marks.add(m)
            for bit in rng.integers(0, 64, 2):
                m ^= 1 << int(bit)
    marks |= {0, 1, 7, 15, (1 << 64) - 1}
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    df = spark.createDataFrame([(signed(m),) for m in marks], "fp bigint")
    roots = {r.node: r.root for r in components.components(simhash.links(df, 3)).collect()}
    want = naive_components(marks, 3)
    groups = lambda pairs: {frozenset(k for k, v in pairs.items() if v == x) for x in set(pairs.values())}
    assert groups({signed(m): roots.get(signed(m), signed(m)) for m in marks}) == groups({signed(m): signed(r) for m, r in want.items()})


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)] + [(500, 500), (None, 3), (700, 600), (600, 700)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 1 for i in range(1, 30)} | {600: 600, 700: 600}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
