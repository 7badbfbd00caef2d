"""Scoring, line dedup, mixing, quality rules and chat formatting against brute force."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from moodtide.llm import chat, decision_list, line_dedup, mixing, suffix_tree
from moodtide.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import ODD_TEXTS
from tools.check import compare, connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


# -- suffix tree ---------------------------------------------------------------------------------
def tree_scores(rows, held, least_count, least_gain):
    """By the definition: dictionaries of contexts, no blocks."""
    texts = [(i, [*WORD.findall((t or "").translate(LOWER)), None]) for i, t in rows]
    learned = [t for i, t in texts if not held(i)]
    count, pairs, triples = collections.Counter(), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for t in learned:
        count.update(t)
        for a, b in zip(t, t[1:]):
            pairs[a][b] += 1
        for a, b, c in zip(t, t[1:], t[2:]):
            triples[a, b][c] += 1
    total, different = sum(count.values()), len(count)
    root = lambda w: (count[w] + 1) / (total + different + 1)

    def rest(after, parent):
        size, kept = sum(after.values()), sum(n - 1 for n in after.values())
        if size < least_count or not kept:
            return None
        twice = [(w, n - 1) for w, n in after.items() if n > 1]
        left = 1 - kept / size
        gain = sum(n * math.log(n / size / parent(w)) for w, n in twice)
        if left > 0:
            gain += size * left * math.log(left / max(1 - sum(parent(w) for w, _ in twice), 1e-12))
        return left if gain >= least_gain else None

    short = {a: rest(after, root) for a, after in pairs.items()}
    one = lambda a, w: root(w) if short.get(a) is None else max(pairs[a][w] - 1, 0) / count[a] + short[a] * root(w)
    long = {ab: rest(after, lambda w, b=ab[1]: one(b, w)) for ab, after in triples.items()}

    def prob(t, k):
        if k == 0:
            return root(t[0])
        if k > 1 and (left := long.get((t[k - 2], t[k - 1]))) is not None:
            return max(triples[t[k - 2], t[k - 1]][t[k]] - 1, 0) / pairs[t[k - 2]][t[k - 1]] + left * one(t[k - 1], t[k])
        return one(t[k - 1], t[k])

    return [(i or -1, held(i), len(t), sum(count[w] > 0 for w in t), total, *([0.0, 0.0] if not total else [
        sum(math.log10(root(w)) for w in t), sum(math.log10(prob(t, k)) for k in range(len(t)))])) for i, t in texts]


def check_tree(docs, rows, held, column, least_count=3, least_gain=0.5):
    got = suffix_tree.score_texts(docs, column, least_count, least_gain).collect()
    want = sorted(tree_scores(rows, held, least_count, least_gain))
    have = sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert [h[:5] for h in have] == [w[:5] for w in want]
    for h, w in zip(have, want):
        assert h[5:] == pytest.approx(w[5:], rel=1e-6, abs=1e-9)


def test_suffix_tree_in_many_blocks(spark, folder, monkeypatch):
    monkeypatch.setattr(suffix_tree, "BLOCK_TOKENS", 9_000)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    check_tree(docs, [tuple(r) for r in docs.collect()], lambda i: i % 7 == 2, F.col("doc_id") % 7 == 2, 4, 2.0)


def test_suffix_tree_with_hot_contexts_and_many_numbers(spark, folder, monkeypatch):
    """N-grams of contexts that are spread, and keys that are hashes, give the same scores; the session's settings stay."""
    monkeypatch.setattr(suffix_tree, "BLOCK_TOKENS", 9_000)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    kept = spark.conf.get(suffix_tree._CLEAN, "false")
    want = sorted(map(tuple, suffix_tree.score_texts(docs, F.col("doc_id") % 7 == 2).collect()))
    assert spark.conf.get(suffix_tree._CLEAN, "false") == kept

    class Wide(suffix_tree._Block):
        def _grams(self, where, context, hashes, numbers, to, size, most):
            hot = np.where(size > 12, np.inf, 0)
            return super()._grams(where, context, hashes, numbers, to, hot, most + (1 << 33))

    monkeypatch.setattr(suffix_tree, "_Block", Wide)
    got = sorted(map(tuple, suffix_tree.score_texts(docs, F.col("doc_id") % 7 == 2).collect()))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5:] for g in got] == [pytest.approx(w[5:], rel=1e-6, abs=1e-9) for w in want]


@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_suffix_tree_of_odd_texts(request, table):
    check_tree(request.getfixturevalue(table), ODD_TEXTS, lambda i: i in (2, 10), F.col("doc_id").isin(2, 10))


def test_suffix_tree_without_training_or_rows(odd, none):
    check_tree(odd, ODD_TEXTS, lambda i: True, F.lit(True))
    assert suffix_tree.score_texts(none, F.lit(False)).count() == 0


def test_suffix_tree_keeps_contexts_by_count_in_a_large_corpus(spark):
    """Eight texts among 24 million symbols are learned from as they are alone."""
    few = spark.range(8).selectExpr("id AS doc_id", "'x y z' AS text")
    filler = spark.range(100, 104).selectExpr("id AS doc_id", "repeat('a ', 6000000) AS text")
    for docs in (few, few.unionByName(filler)):
        got = suffix_tree.score_texts(docs, F.lit(False)).filter("doc_id < 100").collect()
        assert len(got) == 8 and {r.mean_depth for r in got} == {(0 + 1 + 1 + 1) / 4}


def test_suffix_tree_moves_no_answer_twice(spark):
    """Blocks and answers lie by block: the last step reads them where they are, whatever their sizes."""
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('a b c ', id % 3) AS text")
    plan = suffix_tree.score_texts(docs, F.lit(False))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2


def test_suffix_tree_asks_little(monkeypatch):
    """Contexts are asked by number, and n-grams only where the shorter ones in them came often enough."""
    class Task:
        get = staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})())

    monkeypatch.setattr(suffix_tree, "TaskContext", Task)
    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.9))}" for _ in range(200)) for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array([False] * 300), pa.array(texts)], ["id", "held", "text"])
    row = next(suffix_tree.tokenized(iter([batch]))).to_pylist()[0]
    block, answer, told, asked = suffix_tree._Block(row, 2, 8), suffix_tree._bucket_answers(8, 2.0), {}, {}
    total = different = 0
    numbered = collections.Counter()
    starts_of = lambda kind: np.cumsum([0, *(numbered[kind, b] for b in range(2))]).astype(np.uint64)

    def tell(questions):
        nonlocal total, different
        table = suffix_tree._asked_table(questions)
        for kind, n, keys in zip(*(table.column(c).to_pylist() for c in ("kind", "n", "keys"))):
            asked.setdefault(kind, []).append((n, len(keys)))
        for bucket in set(table.column("bucket").to_pylist()):
            for r in answer(table.filter(pa.array([b == bucket for b in table.column("bucket").to_pylist()]))).to_pylist():
                if r["block"] < 0:
                    total, different = total + r["total"] * (r["kind"] == suffix_tree.WORD), different + r["different"] * (r["kind"] == suffix_tree.WORD)
                    numbered[r["kind"], r["bucket"]] = r["numbered"]
                else:
                    told[r["kind"], r["bucket"]] = r["told"]

    tell(block.word_questions())
    block.hear_words(told, total, different, starts_of(suffix_tree.WORD))
    tell(block.pair_questions())
    block.hear_pairs(told, starts_of(suffix_tree.PAIR))
    tell(block.short_and_triple_questions())
    block.hear_short_and_triples(told)
    tell(block.long_questions())
    sizes = {kind: [sum(x) for x in zip(*rows)] for kind, rows in asked.items()}
    for kind in (suffix_tree.SHORT, suffix_tree.LONG):
        assert sizes[kind][0] > 100 and sizes[kind][1] < 2 * sizes[kind][0]  # a hash takes some six bytes
    for kind in (suffix_tree.PAIR, suffix_tree.TRIPLE):
        assert sizes[kind][1] < 4 * sizes[kind][0]
    words = [t.split() for t in texts]
    count = collections.Counter(w for t in words for w in t)
    pairs = collections.Counter(p for t in words for p in zip(t, [*t[1:], None]))
    triples = {(a, b, c) for t in words for a, b, c in zip(t, t[1:], [*t[2:], None])}
    assert sizes[suffix_tree.PAIR][0] == sum(count[a] >= 8 and (b is None or count[b] >= 2) for a, b in pairs) < len(pairs)
    assert sizes[suffix_tree.TRIPLE][0] == sum(pairs[a, b] >= 8 and pairs[b, c] >= 2 for a, b, c in triples) < len(triples)


# -- line dedup ----------------------------------------------------------------------------------
def brute_lines(rows, least):
    """Rows are ordered by id and then by no more: ids in these tests are unique, but for equal rows."""
    seen, out = [], {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        kept = []
        for line in (text or "").split("\n"):
            words = tuple(WORD.findall(line.translate(LOWER)))
            gone = words and any(words == s or len(words) >= least and len(s) >= least and line_dedup.within_one(list(words), list(s)) for s in seen)
            if words:
                seen.append(words)
            if not gone:
                kept.append(line)
        out[i] = "\n".join(kept)
    return out


def check_lines(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"line": F.lit(1), "n_lines": F.lit("x"), "h": F.lit(2)})
    got = line_dedup.line_dedup(docs).collect()
    want = brute_lines(rows, line_dedup.LEAST_WORDS)
    assert len(got) == len(rows)
    for r in got:
        text = dict(rows)[r.doc_id]
        assert (r.text or "") == want[r.doc_id]
        assert r.n_lines == sum(bool(WORD.search(x)) for x in (text or "").split("\n"))
        assert r.n_removed == len((text or "").split("\n")) - (len(want[r.doc_id].split("\n")) if want[r.doc_id] or r.n_removed < len((text or "").split("\n")) else 0)


def test_line_dedup_of_random_edits(spark):
    rng = random.Random(2)
    letters = list("abcdefgh")
    lines = [[rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 4, 5, 6, 7, 12]))] for _ in range(25)]
    rows = []
    for i in range(40):
        own = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(lines))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randint(0, len(line))
                how = rng.random()
                line[at:at + (how < 0.6)] = [rng.choice(letters)] * (how > 0.3)
            own.append(rng.choice([" ", "  ", "\t"]).join(line).replace("a", rng.choice("aA")))
        rows.append((i, "\n".join(own)))
    check_lines(spark, rows)


def test_line_dedup_of_odd_texts(spark, none):
    rows = [(i, t) for k, (i, t) in enumerate(ODD_TEXTS) if (i, t) != (5, ODD_TEXTS[10][1])]
    check_lines(spark, rows)
    assert line_dedup.line_dedup(none).count() == 0


def test_within_one_word():
    rng = random.Random(1)
    for _ in range(3000):
        a, b = ([rng.choice(b"ab") for _ in range(rng.randint(0, 5))] for _ in range(2))
        near = a == b or any(a[:i] + a[i + 1:] == b for i in range(len(a))) or any(b[:i] + b[i + 1:] == a for i in range(len(b))) or (
            len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1)
        assert line_dedup.within_one(a, b) == near


# -- mixing --------------------------------------------------------------------------------------
def pour(budget, nodes):
    """Water filling by rounds: ``nodes`` are name -> (weight, limit)."""
    given, open_ = {}, dict(nodes)
    while open_:
        weight = sum(w for w, _ in open_.values())
        full = {n: m for n, (w, m) in open_.items() if m * weight <= w * budget}
        if not full:
            return given | {n: budget * w // weight for n, (w, _) in open_.items()}
        n = min(full, key=lambda k: (full[k] / open_[k][0] if open_[k][0] else math.inf, k))
        given[n] = full[n]
        budget -= full[n]
        del open_[n]
    return given


def test_budgets_are_poured_level_by_level(spark):
    rng = random.Random(4)
    leaves = [(f"d{d}", f"l{x}", f"s{s}", rng.randint(0, 1000)) for d in range(3) for x in range(rng.randint(1, 3)) for s in range(rng.randint(1, 4))]
    weights = {"d": {"d0": 5, "d2": 0}, "l": {"l1": 3}, "s": {"s0": 2}}
    df = spark.createDataFrame(leaves, "d string, l string, s string, tokens bigint")
    for epochs, budget in ((1, 1500), (2, 6000), (3, 10**6), (1, 0)):
        got = {(r.d, r.l, r.s): r.budget for r in mixing.budgets(df, ["d", "l", "s"], weights, epochs, budget).collect()}
        most = lambda key: epochs * sum(t for *k, t in leaves if k[:len(key)] == list(key))
        want = {(): budget}
        for depth, level in enumerate(["d", "l", "s"]):
            below = {}
            for parent, amount in want.items():
                names = {k[depth] for *k, _ in leaves if tuple(k[:depth]) == parent}
                poured = pour(amount, {n: (weights[level].get(n, 1), most((*parent, n))) for n in names})
                below |= {(*parent, n): b for n, b in poured.items()}
            want = below
        assert got == want


def test_mix_of_odd_texts_keeps_columns_and_order_of_epochs(odd, clashing, none):
    levels = {"kind": F.when(F.length("text") > 20, "long").otherwise("short"), "all": F.lit(None).cast("string")}
    for docs in (odd, clashing):
        once = mixing.mixed(docs, levels, {}, epochs=1, budget=10**6)
        assert once.columns == docs.columns
        text = lambda df: sorted(str(r.text) for r in df.collect() if WORD.search(r.text or ""))
        assert text(once) == text(docs)
        assert text(mixing.mixed(docs, levels, {}, epochs=3, budget=10**6)) == sorted(text(docs) * 3)
        assert text(mixing.mixed(docs, levels, {"kind": {"short": 0}}, epochs=3, budget=3)) in ([], ["Word"], ["Word", "Word"])
    assert mixing.mixed(none, levels, {}).count() == 0


# -- quality rules -------------------------------------------------------------------------------
@pytest.mark.parametrize("table", ["odd", "clashing"])
def test_statistics_by_hand(request, table):
    got = decision_list.statistics(request.getfixturevalue(table)).collect()
    want = []
    for i, t in ODD_TEXTS:
        t = t or ""
        words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        at = collections.defaultdict(list)
        for k in range(len(words) - 4):
            at[tuple(words[k:k + 5])].append(k)
        covered = {k + j for places in at.values() if len(places) > 1 for k in places for j in range(5)}
        want.append((i or -1, len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)))
    assert sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted(want)


def test_statistics_of_texts_that_begin_and_end_with_f_or_form_feed(spark):
    texts = ["for you and half", "f", "ff f", "\fone two\f", "\x0bfour\x0b", "\r\n\t f \f", "\f", "five words of a proof\fproof of f"]
    got = decision_list.statistics(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    want = [(i, len(w), sum(map(len, w)), len(set(w))) for i, w in ((i, WORD.findall(t)) for i, t in enumerate(texts))]
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_different) for r in got) == want


def test_rules_are_learned_and_prune_what_does_not_hold(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    rows, labels = [], []
    for i in range(400):
        words = [word() for _ in range(rng.randint(20, 60))]
        bad = i % 4 == 0
        if bad:
            words = [w.upper() for w in words] if i % 8 else [f"{w}$$" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if bad else 1, None))
    labels += [(None, 0, 1), (3, None, 1), (99_999, 0, 0)]
    docs, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, n_words int")
    judged, rules = decision_list.judge(docs, known)
    assert 1 <= len(rules.rules) <= 4
    assert {(r.doc_id % 4 == 0, r.kept) for r in judged.collect()} == {(True, False), (False, True)}
    for nothing in (known.limit(0), known.filter("quality = 1")):
        judged, rules = decision_list.judge(docs, nothing)
        assert rules.rules == () and judged.filter("kept").count() == 400
    assert decision_list.judge(docs.limit(0), known)[0].count() == 0


# -- chat ----------------------------------------------------------------------------------------
TREE = [  # tree, message, parent, score, role, text
    ("t", 1, None, 0.0, "user", "q"), ("t", 2, 1, 1.0, "assistant", "a"), ("t", 3, 1, 5.0, "assistant", "b </s>"), ("t", 4, 2, 9.0, "user", "more"),
    ("t", 5, 3, 1.0, None, None), ("t", 6, 99, 2.0, "user", "orphan"), (None, 1, None, None, "user", "no tree"), ("loop", 1, 2, 1.0, "user", "x"), ("loop", 2, 1, 1.0, "user", "y"),
    ("t", None, 1, 50.0, "user", "no message"), ("t", 4, 2, 9.0, "user", "more again"), ("u", 1, None, 1.0, "user", "tie"), ("u", 2, None, 1.0, "user", "tie"),
]


def messages(spark, work, rows):
    path = work()
    spark.createDataFrame(rows, "tree string, message bigint, parent bigint, score double, role string, text string").withColumn("path", F.lit(1)).write.parquet(path)
    return spark.read.parquet(path)


def test_branches_of_reply_trees(spark, work):
    got = chat.conversations(messages(spark, work, TREE), keep=2).select("tree", "branch", chat.read_turns(F.col("formatted")).alias("t"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    have = {(r.tree, r.branch): ([(x.role, x.text) for x in r.t], r.loss) for r in got.collect()}
    assert have == {
        ("t", 1): ([("user", "q"), ("assistant", "a"), ("user", "more")], "a"),
        ("t", 2): ([("user", "q"), ("assistant", "b </s>"), ("", "")], "b </s>"),
        (None, 1): ([("user", "no tree")], ""), ("u", 1): ([("user", "tie")], ""), ("u", 2): ([("user", "tie")], "")}
    assert chat.conversations(messages(spark, work, TREE[:0])).count() == 0


def test_long_chains_take_few_rounds(spark, work):
    rows = [("c", i, i - 1 if i else None, 1.0, "user" if i % 2 else "assistant", f"turn {i}") for i in range(300)]
    got = chat.conversations(messages(spark, work, rows)).select(chat.read_turns(F.col("formatted")).alias("t")).collect()
    assert [x.text for x in got[0].t] == [f"turn {i}" for i in range(300)] and len(got) == 1


def test_escapes_are_reversible_and_hide_control_strings(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("<>[]|/\\sINT\n_é") for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["</s>", "<|user|>", "[INST]", "\\", "<\\"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect()
    assert all(r.t == r.u for r in rows)
    assert not any(c in r.e for r in rows for c in ("</s>", "<|", "[INST]", "[/INST]", "|>"))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert compare(df.collect(), df.schema, connect(folder).sql(ORACLES[name]).to_arrow_table()) == ""
