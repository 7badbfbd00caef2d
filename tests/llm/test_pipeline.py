"""Toxicity on a small labelled table, and every stage of the pipeline against brute force over its own input."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from moodtide.llm import queries, shingle_join, simhash, string_kernel
from tests.llm.conftest import ODD_TEXTS
from tests.llm.test_texts import brute_lines
from tests.llm.test_tokens import check_packing

INSULTS = ["blockhead", "nitwit", "scoundrel"]


def labelled(n=600):
    rng = random.Random(3)
    syllables = ["ba", "ko", "ter", "lin", "mu", "sha", "ve", "dro", "pi", "en"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(10, 80))]
        if i % 5 == 0:
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        text = " ".join(words)
        rows.append((i, text[:40] + "." + text[40:]))
        labels.append((i, 1, int(i % 5 == 0)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = labelled()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame([*labels, (None, 1, 1), (7, None, None)], "doc_id bigint, quality int, toxic int")
    return string_kernel.fit(docs, known), docs


def test_held_out_documents_are_told_apart(model):
    fitted, docs = model
    held = string_kernel.scored(docs, fitted).filter(string_kernel.held_out(F.col("doc_id"))).collect()
    assert len(held) > 80
    assert sum((r.score >= 0.5) == (r.doc_id % 5 == 0) for r in held) >= 0.98 * len(held)


def test_changed_insults_are_found(spark, model):
    clean = "ba ko terlin mushave dropien linko"
    given = ["block-head", "b.l.o.c.k.h.e.a.d", "n i t w i t", "scoundrrel", "blockkhead", "NITWIT!!", "scoun*drel"]
    docs = spark.createDataFrame([(i, f"{clean} {w} {clean}") for i, w in enumerate(given)] + [(100, clean)], "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in string_kernel.scored(docs, model[0]).collect()}
    assert [w for i, w in enumerate(given) if got[i] < 0.5] == [] and got[100] < 0.5


def test_toxicity_of_odd_tables(spark, model, clashing, none):
    scored = string_kernel.scored(clashing, model[0], name="toxicity")
    assert scored.columns == [*clashing.columns, "toxicity"] and scored.count() == len(ODD_TEXTS)
    assert all(0 <= r.toxicity < 0.5 for r in scored.collect())
    assert string_kernel.scored(none, model[0]).count() == 0
    labels = spark.createDataFrame([(i, 1) for i in range(1, 11)], "doc_id bigint, toxic int")
    for known, share in ((labels, 1.0), (labels.withColumn("toxic", F.lit(0)), 0.0), (labels.limit(0), 0.0)):
        flat = string_kernel.fit(clashing, known)
        assert {round(r.score, 6) for r in string_kernel.scored(clashing.select("doc_id", "text"), flat).collect()} == {share}


def test_query_predicts_by_its_score(spark, folder):
    got = queries.QUERIES["op10_string_kernel"](spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_stages_against_brute_force(spark, folder, work):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        path = work()
        out.write.parquet(path)
        kept[name] = spark.read.parquet(path)
        if name != "packing":
            assert kept[name].schema == docs.schema
            docs = kept[name]
    rows = lambda name: {r.doc_id: r for r in kept[name].collect()}
    first = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    calm = rows("toxicity")
    assert all(first[i] == r for i, r in calm.items()) and len(calm) > 0.6 * len(first)
    lined = rows("line_dedup")
    assert {i: r.text for i, r in lined.items()} == brute_lines([(i, r.text) for i, r in calm.items()], 5)
    assert all(r.n_chars == len(r.text) for r in lined.values())
    single = rows("near_dedup")
    assert set(single) == set(jaccard_roots({i: r.text for i, r in lined.items()}).values()) and all(lined[i] == r for i, r in single.items())
    path = work()
    kept["near_dedup"].coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(i for i, n in con.execute(f"SELECT doc_id, copies FROM ({queries.MIX_SQL})").fetchall() for _ in range(n))
    assert sorted(r.doc_id for r in kept["mix"].collect()) == want
    check_packing(spark, kept["mix"], [(r.doc_id, r.text) for r in kept["mix"].collect()], 1024, work())
    assert kept["packing"].agg(F.sum("length")).first()[0] > 0


def test_near_dedup_keeps_one_of_repeated_rows(spark, folder):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, text, "en", "src1", 1), (5, text, "en", "src1", 1), (5, "something else altogether that has a fair number of words in it", "de", "src2", 2), (None, text, "en", "s", 1),
            (2, None, None, None, None), (3, "", None, None, 0), (9, text.upper(), "en", "src3", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")
    got = corpus_pipeline.near_dedup(spark, docs, folder).collect()
    assert len(got) == 3 and {r.text for r in got} >= {"something else altogether that has a fair number of words in it"}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, folder)
        assert out.count() == 0


def test_run_is_the_last_stage(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def jaccard_roots(texts, size=5):
    """By the definition: all pairs of shingle sets."""
    def shingles(text):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        return {tuple(words[i:i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()

    found = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(found):
        for j in sorted(found):
            if i < j and (found[i] == found[j] or 5 * len(found[i] & found[j]) >= 4 * len(found[i] | found[j])):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in texts}


def planted():
    """Texts of all lengths with copies of one to some changed words, one large family of copies, and a passage that many texts share."""
    rng = random.Random(12)
    word = lambda: f"{rng.choice('bcdfgklmnprst')}{rng.choice('aeiou')}{rng.randint(0, 400)}"
    passage = [word() for _ in range(40)]
    texts = [None, "", " ", "one", "One", "a b c d", "a b c e"]
    for n in (5, 6, 12, 50, 60, 100, 200, 400):
        for _ in range(6):
            base = [word() for _ in range(n)]
            texts.append(" ".join(base))
            for changes in (1, 1, 2, 3, 5):
                copy = list(base)
                for at in rng.sample(range(n), min(changes, n)):
                    copy[at] = word()
                texts.append(" ".join(copy))
    family = [word() for _ in range(150)]
    for i in range(90):
        texts.append(" ".join([*family[:i % 30], word(), *family[i % 30:]]))
        texts.append(" ".join([*passage, *(word() for _ in range(rng.choice([5, 8, 60])))]))
    return dict(enumerate(texts))


@pytest.mark.parametrize("sample", [16, 1])
def test_near_dedup_links_all_pairs_of_similarity_08(spark, folder, sample):
    texts = planted()
    root = jaccard_roots(texts)
    assert len(set(root.values())) < len(texts) - 150
    docs = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in texts.items()], "doc_id bigint, text string, lang string, source string, n_chars int").repartition(5)
    found = {r.id: r.root for r in shingle_join.near_duplicates(docs, sample=sample).collect()}
    groups = lambda of: {frozenset(i for i in of if of[i] == x) for x in set(of.values())}
    assert groups(found) == groups(root)
    if sample > 1:
        assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, folder).collect()} == set(root.values())


def test_near_dedup_takes_links_of_fingerprints(spark, folder, monkeypatch):
    texts = planted()
    docs = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in texts.items()], "doc_id bigint, text string, lang string, source string, n_chars int")
    asked, given, tiles = [], [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda marks, radius: asked.append((marks, radius)) or given.append(tiles(marks, radius)) or given[0])
    got = corpus_pipeline.near_dedup(spark, docs, folder)
    assert {r.doc_id for r in got.collect()} == set(jaccard_roots(texts).values())
    assert asked[0][1] == 3 and given[0].count() > 10
    assert {r.fp for r in asked[0][0].collect()} == {r.fp for r in simhash.fingerprints(docs, 5).collect()}


def test_proposed_links_are_verified(spark):
    """A wrong proposal, by links or by an equal fingerprint, links nothing; a right one and no proposal give the same."""
    line = [f"w{i}" for i in range(40)]
    texts = {1: " ".join(line), 2: " ".join([*line, "x"]), 3: "another text of some words that are its own", 4: " ".join([*line[:35], "y"])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    marks = spark.createDataFrame([(r.mark, r.id if r.id != 3 else 1) for r in simhash.fingerprints(docs, 5).collect()], "mark bigint, fp bigint")
    roots = jaccard_roots(texts)
    groups = lambda of: {frozenset(i for i in of if of[i] == x) for x in set(of.values())}
    for pairs in ([], [(1, 2)], [(1, 2), (1, 4), (2, 4)]):
        near = spark.createDataFrame(pairs, "a bigint, b bigint")
        found = {r.id: r.root for r in shingle_join.near_duplicates(docs, fingerprints=marks, near=near).collect()}
        assert groups(found) == groups(roots)


def test_prefix_of_a_set_leaves_less_than_similar_sets_share():
    assert [shingle_join.prefix(n) for n in (0, 1, 4, 5, 6, 100)] == [0, 1, 1, 2, 2, 21]


def test_stages_of_odd_tables(spark, folder):
    """Null and very long texts, repeated rows and columns that operators use inside: every stage runs, keeps the columns and what it does not touch."""
    names = ["_score_", "_text_", "n_lines", "n_removed", "id", "mark", "root", "h", "copies", "piece", "length", "part", "n_tokens", "domain", "words"]
    long = " ".join(random.Random(1).choice(["ba", "ko", "ter", "lin", "mushave"]) + random.Random(i).choice(["", "", "", ".", "\n"]) for i in range(40_000))
    rows = [(1, long, "en", "src1", 3), (2, long + " more", "en", "src1", 3), (3, None, None, None, None), (4, "", "de", "src2", 0), (4, "", "de", "src2", 0), (None, "two words", "de", "src2", 9),
            (5, "a line of five different words\na line of five different words", "fr", "src3", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int").select("*", *[F.lit(f"own {c}").alias(c) for c in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        got = out.collect()
        assert out.columns == docs.columns and got and all(r[c] == f"own {c}" for r in got for c in names), name
        if name == "toxicity":
            assert len(got) == len(rows)
        if name == "line_dedup":
            assert {r.text for r in got if r.doc_id == 5} == {"a line of five different words"} and {r.text for r in got if r.doc_id == 3} == {None}
        if name == "near_dedup":
            assert {r.doc_id for r in got} == {1, 3, None, 5} or {r.doc_id for r in got} == {1, 3, 5, None, 4}
    packed = corpus_pipeline.packing(spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == {r[0] for r in rows} and max(r.length for r in packed) <= 1024
