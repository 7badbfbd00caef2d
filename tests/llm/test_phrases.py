"""Collocations, decontamination and spelling variants against brute force, and their defined cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moodtide.llm import collocations, spelling, winnowing
from moodtide.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import ODD_TEXTS
from tools.check import compare, connect

LOWER = {i: i + 32 for i in range(65, 91)}
LONG = " ".join(random.Random(4).choice("the of and in to a on by".split()) + random.Random(i).choice(["", "", ".", "\n"]) for i in range(60_000))


def lowered(text):
    return (text or "").translate(LOWER)


@pytest.mark.parametrize("name", ["op11_collocations", "op12_winnowing", "op13_spelling"])
def test_queries_equal_their_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert compare(df.collect(), df.schema, connect(folder).sql(ORACLES[name]).to_arrow_table()) == ""


# -- collocations --------------------------------------------------------------------------------
def best_phrases(rows, longest, least, share, top):
    """By the definition: one counter for each language."""
    found = collections.defaultdict(collections.Counter)
    total = collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for i in range(len(w)):
                for n in range(1, longest + 1):
                    if i + n <= len(w):
                        found[lang or "und"][tuple(w[i:i + n])] += 1
    out = []
    for lang, f in found.items():
        known = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i:i + n] for p, a in known.items() for n in range(2, len(p)) for i in range(len(p) - n + 1) if 100 * a >= share * f[p[i:i + n]]}
        scored = []
        for p, a in known.items():
            if p not in gone:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def texts_of(seed, rows, words, size):
    rng = random.Random(seed)
    some = [rng.choice("abcdefgé") * rng.randint(1, 2) + rng.choice("xyz") for _ in range(words)]
    join = lambda: rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " x! "])
    return [(rng.choice(["en", "de", None]), "".join(rng.choice(some) + join() for _ in range(rng.randint(0, size)))) for _ in range(rows)]


@pytest.mark.parametrize("longest, least, share, top, sizes", [
    (3, 10, 50, 2000, {}), (3, 2, 50, 7, {"bucket_bytes": 500, "fan": 3}), (2, 3, 50, 50, {"bucket_bytes": 2000}), (4, 2, 80, 40, {"bucket_bytes": 900, "fan": 2})])
def test_collocations(spark, longest, least, share, top, sizes):
    rows = texts_of(longest + least, 120, 14, 60)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.collocations(docs, longest, least, share, top, **sizes).collect()
    want = best_phrases(rows, longest, least, share, top)
    assert sorted(map(tuple, got)) == want and want


def test_collocations_of_odd_texts(spark, clashing, none):
    docs = clashing.withColumn("lang", F.lit(None).cast("string"))
    got = collocations.collocations(docs, least=2).collect()
    assert sorted(map(tuple, got)) == best_phrases([(None, t) for _, t in ODD_TEXTS], 3, 2, 50, 2000)
    assert collocations.collocations(none.withColumn("lang", F.lit("en"))).count() == 0
    long = spark.createDataFrame([("en", LONG), ("en", LONG), ("en", None)], "lang string, text string")
    assert sorted(map(tuple, collocations.collocations(long).collect())) == best_phrases([("en", LONG)] * 2, 3, 10, 50, 2000)


def test_messages_keep_their_windows():
    rng = np.random.default_rng(3)
    words = pa.array([b"a", "é".encode(), b"ccc", b"d" * 300], pa.large_binary())
    columns, n = collocations.counted([rng.integers(0, 5, 400) for _ in range(3)], np.ones(400), 5)
    got, m, kept = collocations.unpacked(collocations.packed(columns, n, words))
    name = lambda w, c: [None if i == len(w) else w[i].as_py() for i in c]
    assert [name(kept, c) for c in got] == [name(words, c) for c in columns] and m.tolist() == n.tolist()


# -- decontamination -----------------------------------------------------------------------------
PARTS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def judged(docs, items, window=10):
    """By the definition: all windows of all items, looked up at every place."""
    of = collections.defaultdict(set)
    for item, text in items:
        w = PARTS.findall(lowered(text))
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            of[tuple(w[i:i + size])].add("" if item is None else str(item))
    sizes = {len(w) for w in of}
    out = []
    for doc, text in docs:
        w = PARTS.findall(lowered(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (x := tuple(w[i:i + size])) in of:
                    hit |= set(range(i, i + size))
                    found |= of[x]
        said = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), said, bool(hit), sorted(found)))
    return out


def corpus(seed):
    """Documents with cut, changed and repeated passages of items, over few words, so that grams repeat."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "c", "é", "7", "D"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 7, 9, 10, 11, 25])))) for i in range(30)] + [(3, "b c"), (None, "a " * 12), (4, None)]
    docs = []
    for i in range(80):
        parts = []
        for _ in range(rng.randint(0, 4)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, len(w))
            parts += w[a:] + [word() for _ in range(rng.randint(0, 12))]
        docs.append((i, rng.choice([" ", "-", " . "]).join(parts)))
    return docs + [(None, "a " * 30), (None, None), (5, docs[5][1]), (5, docs[6][1])], items


@pytest.mark.parametrize("seed, least, most_broadcast", [(1, 0, 200_000), (2, 9, 200_000), (3, 9, 0), (4, 10, 0)])
def test_decontamination(spark, seed, least, most_broadcast):
    docs, items = corpus(seed)
    items = [x for x in items if len((x[1] or "").split()) >= least]
    got = winnowing.decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), most_broadcast=most_broadcast)
    order = lambda rows: sorted(map(str, map(tuple, rows)))
    want = judged(docs, items)
    assert order(got.collect()) == order(want) and {w[5] for w in want} == {True, False}


def test_decontamination_of_odd_texts(spark, clashing, none):
    items = spark.createDataFrame([(1, "the QUICK brown fox, jumps over the lazy dog!"), (2, LONG)], "item_id int, text string").withColumn("kept", F.lit(1)).withColumn("item", F.lit(2))
    docs = clashing.select("doc_id", "text", *[F.lit(0).alias(c) for c in ("kept", "mark", "words", "items", "spans", "length", "h", "at")])
    docs = docs.unionByName(docs.limit(1).withColumn("text", F.lit("x " + LONG + " y")))
    order = lambda rows: sorted(str(tuple(r)) for r in rows)
    want = judged([tuple(r) for r in docs.select("doc_id", "text").collect()], [(1, "the quick brown fox jumps over the lazy dog"), (2, LONG)])
    assert order(winnowing.decontaminate(docs, items).collect()) == order(want)
    assert winnowing.decontaminate(none, items).count() == 0
    assert not winnowing.decontaminate(docs, items.limit(0)).filter("contaminated or n_hit > 0 or n_items > 0").count()


def test_every_shared_window_keeps_a_hash(spark):
    """The guarantee itself: a window in both texts has a kept hash at the same place of both."""
    rng = random.Random(9)
    rows = [(i, [rng.choice("abc") for _ in range(rng.randint(0, 40))]) for i in range(60)]
    kept = {r.i: {(k.at, k.h) for k in r.kept} for r in winnowing.fingerprints(spark.createDataFrame(rows, "i int, words array<string>"), [6]).collect()}
    for i, a in rows:
        for j, b in rows:
            for p in range(len(a) - 5):
                for q in range(len(b) - 5):
                    if a[p:p + 6] == b[q:q + 6]:
                        inside = lambda x, s: {(at - s, h) for at, h in kept[x] if s <= at <= s + 3}
                        assert inside(i, p) & inside(j, q)


# -- spelling ------------------------------------------------------------------------------------
def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelled(rows, every, least_letters, least, factor):
    n = collections.Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if every and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    words = {w: k for w, k in n.items() if len(w) >= least_letters and k >= least}
    beside = {w: sorted((v for v in words if near(w, v)), key=lambda v: (-words[v], v)) for w in words}
    form = {w: b[0] if b and words[b[0]] >= factor * words[w] else None for w, b in beside.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), words[w], len(beside[w]), words.get(form[w])) for w in words)


def misspelled(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randint(5, 9))) for _ in range(25)]
    text = []
    for _ in range(4000):
        w = base[min(int(rng.expovariate(0.4)), 24)]
        while rng.random() < 0.3:
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abcÀ") + w[i:], w[:i] + rng.choice("abc") + w[i + 1:]])
        text.append(w.upper() if rng.random() < 0.1 else w)
    return [(rng.choice([None, *range(30)]), rng.choice([" ", "1", "×, "]).join(text[i:i + 50])) for i in range(0, 4000, 50)]


@pytest.mark.parametrize("seed, every, least_letters, least, factor", [(1, 199, 6, 5, 5), (2, 3, 4, 2, 2), (3, None, 1, 1, 3)])
def test_spelling(spark, seed, every, least_letters, least, factor):
    rows = misspelled(seed)
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    want = spelled(rows, every, least_letters, least, factor)
    assert sorted(map(tuple, spelling.variants(docs, every, least_letters, least, factor).collect())) == want
    assert any(w[1] for w in want)


def test_roots_follow_all_forms(spark):
    """Six words, each one edit from the next and five times rarer: all go back to the last."""
    chain = ["abcdefg", "abcdefx", "abcdeyx", "abcdzyx", "abcqzyx", "abrqzyx"]
    docs = spark.createDataFrame([(i, " ".join([w] * 5 ** (i + 1))) for i, w in enumerate(chain)], "doc_id int, text string")
    assert {r.word: (r.form, r.root) for r in spelling.variants(docs).collect()} == {w: (chain[i + 1] if i < 5 else None, chain[5]) for i, w in enumerate(chain)}


@pytest.mark.parametrize("classes, tile", [(2, 3), (5, 1024), (3, 1)])
def test_near_words_by_any_cells(spark, classes, tile):
    rng = random.Random(classes)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(150)} | {"a" * 4000, "a" * 4001, "a" * 2000 + "b" + "a" * 1999}
    rows = spelling.near_words(spark.createDataFrame([(w, len(w)) for w in sorted(words)], "word string, n bigint"), classes, tile).collect()
    assert sorted((r.word, r.other) for r in rows) == sorted((a, b) for a in words for b in words if near(a, b))
    assert all((r.n, r.other_n) == (len(r.word), len(r.other)) for r in rows)


def test_spelling_of_odd_texts(spark, clashing, none):
    assert sorted(map(tuple, spelling.variants(clashing, 3, 1, 1, 1 << 20).collect())) == spelled(ODD_TEXTS, 3, 1, 1, 1 << 20)
    assert spelling.variants(none).count() == 0
    long = [(1, "a" * 50_000 + " " + LONG), (None, None)]
    assert sorted(map(tuple, spelling.variants(spark.createDataFrame(long, "doc_id int, text string"), 199, 1, 1, 5).collect())) == spelled(long, 199, 1, 1, 5)
