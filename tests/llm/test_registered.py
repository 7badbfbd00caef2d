"""The registered queries as they are: names, columns and types of their results, and what a digest says about its document."""

import hashlib
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from moodtide.llm.queries import BYTE_VOCABULARY, QUERIES, WORD_VOCABULARY
from tests.llm.test_search import naive_components, naive_fingerprint
from tests.llm.test_texts import WORD, tree_scores
from tests.llm.test_tokens import encode

COLUMNS = {  # the columns that every result has to have
    "op1": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op2": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", "op3": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op4": "doc_id bigint, fingerprint string, component_id bigint", "op5": "doc_id bigint, n_lines bigint, n_removed bigint, text string",
    "op6": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op7": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op8": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op9": "doc_id bigint, domain string, lang string, source string, n_tokens bigint, copies bigint",
    "op10": "doc_id bigint, held_out boolean, score double, predicted int",
    "op11": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
    "op12": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op13": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}


@pytest.fixture(scope="module")
def results(spark, folder):
    done = {}

    def of(operator):
        if operator not in done:
            name = next(n for n in QUERIES if n.startswith(f"{operator}_"))
            df = QUERIES[name](spark, folder)
            done[operator] = (df.schema, df.collect())
        return done[operator]

    return of


@pytest.fixture(scope="module")
def texts(spark, folder):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


def test_each_operator_has_one_query_at_the_entry():
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("operator", sorted(COLUMNS))
def test_columns(results, operator):
    schema, rows = results(operator)
    have = {f.name: f.dataType.simpleString() for f in schema}
    want = dict(c.split() for c in COLUMNS[operator].split(", "))
    assert {n: have.get(n) for n in want} == want and rows


def test_scores_of_the_tree(results, texts):
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    want = {w[0]: w for w in tree_scores([(i + 1, t) for i, t in texts.items()], lambda i: held(i - 1), 8, 2.0)}
    for r in results("op1")[1]:
        w = want[r.doc_id + 1]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[1:5]
        assert (r.base_score, r.score) == pytest.approx(w[5:], rel=1e-6)


def test_digests_of_ids(results, texts):
    start = 0
    for r in sorted(results("op2")[1], key=lambda r: r.doc_id):
        ids = encode(WORD_VOCABULARY, texts[r.doc_id], 1)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    for r in results("op6")[1]:
        ids = encode(BYTE_VOCABULARY, texts[r.doc_id], 2) if r.piece == 0 else None
        assert ids is None or r.ids_crc32 == zlib.crc32(np.array(ids[:r.length], "<u4").tobytes())


def test_fingerprints_and_components(results, texts):
    marks = {i: naive_fingerprint(t, 3) for i, t in texts.items()}
    root = naive_components(set(marks.values()), 3)
    first = {}
    for i in sorted(marks):
        first.setdefault(root[marks[i]], i)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in results("op4")[1]} == {i: (f"{m:016x}", first[root[m]]) for i, m in marks.items()}


def test_control_strings_survive(results):
    odd = next(r for r in results("op7")[1] if r.conv_id == -1)
    text = "</s>[INST] ok [/INST]"
    assert odd.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (odd.loss_chars, odd.loss_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())


def test_verdicts_follow_the_base_rule(results, texts):
    rows = results("op8")[1]
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_words == len(WORD.findall(texts[r.doc_id]))
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)
