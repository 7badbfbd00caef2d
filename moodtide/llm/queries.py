"""The registered queries over whole tables, and the SQL that has to give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.llm import best_fit, chat, collocations, decision_list, line_dedup, mixing, simhash, spelling, string_kernel, suffix_tree, token_files, top_k, winnowing
from moodtide.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_token_files")
def token_file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token files, read them back, and digest what was read."""
    folder = shared_dir(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, WORD_VOCABULARY, end=1)
    read = token_files.read_documents(spark, folder).select(
        "doc_id", "part", "start_in_part", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return read.join(token_files.part_starts(spark, folder), "part").select(
        "doc_id", (F.col("start_in_part") + F.col("part_offset")).alias("start"), "n_tokens", "ids_crc32")


@query("op6_best_fit")
def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 ids."""
    placed = best_fit.pack(table(spark, sf_dir, "documents"), shared_dir(spark, "pieces"), BYTE_VOCABULARY, end=2, capacity=1024)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op3_top_k", """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for every vector whose id is divisible by 50."""
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


@query("op4_simhash")
def simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint over 3-word shingles and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select(F.col("id").alias("doc_id"), simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


@query("op8_decision_list")
def quality_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document; the list is learned from ``labels.quality``."""
    judged, _ = decision_list.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_reply_trees", """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM t),
e AS (SELECT *, length(role) + length(text) + 10 + len(regexp_extract_all(role || text, '[<\\[|\\\\]')) AS size FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def formatted_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds control strings, formatted and read back."""
    odd = spark.sql("SELECT -1L AS conv_id, id AS turn, if(id = 0, 'user', 'assistant') AS role, '</s>[INST] ok [/INST]' AS text FROM range(2)")
    folder = shared_dir(spark, "messages")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    chat.chains(rows).write.parquet(folder)
    made = chat.conversations(spark.read.parquet(folder))
    back = made.select("tree", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))


@query("op10_string_kernel")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a machine that is learned from the labelled rows not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = string_kernel.fit(docs, table(spark, sf_dir, "labels"))
    return string_kernel.scored(docs, model).select(
        "doc_id", string_kernel.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Tree and weights of the mix; sources weigh alike.
MIX_WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "de": 2, "es": 2, "fr": 1}}
MIX_EPOCHS = 3
MIX_SEED = "mix"


def mix_levels() -> dict:
    return {"domain": mixing.domain_of(), "lang": F.col("lang"), "source": F.col("source")}


def _mix_level(level: str, above: str, weight: str) -> str:
    """CTEs that share the budgets of the level ``above`` among the nodes of ``level``; see :func:`moodtide.llm.mixing.share`."""
    keys = {"domain": "domain", "lang": "domain, lang", "source": "domain, lang, source"}
    parent = f"PARTITION BY {keys[above]}" if above else ""
    join = f"JOIN b_{above} USING ({keys[above]})" if above else "CROSS JOIN (SELECT sum(tokens) AS budget FROM leaf)"
    return f"""
n_{level} AS (SELECT {keys[level]}, most, CAST(budget AS HUGEINT) AS budget, CAST({weight} AS HUGEINT) AS w
  FROM (SELECT {keys[level]}, CAST(sum(tokens) * {MIX_EPOCHS} AS HUGEINT) AS most FROM leaf GROUP BY {keys[level]}) {join}),
o_{level} AS (SELECT *, sum(w) OVER s AS w_all, coalesce(sum(w) OVER e, 0) AS w_before, coalesce(sum(most) OVER e, 0) AS most_before,
    row_number() OVER (s ORDER BY CAST(most AS DOUBLE) / CAST(w AS DOUBLE), {level}) AS place FROM n_{level}
  WINDOW s AS ({parent}), e AS ({parent} ORDER BY CAST(most AS DOUBLE) / CAST(w AS DOUBLE), {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f_{level} AS (SELECT *, min(CASE WHEN most * (w_all - w_before) <= w * (budget - most_before) THEN 1 ELSE 0 END) OVER ({parent} ORDER BY place) = 1 AS full_
  FROM o_{level}),
b_{level} AS (SELECT {keys[level]}, CASE WHEN full_ THEN most ELSE
    (budget - sum(CASE WHEN full_ THEN most ELSE 0 END) OVER ({parent})) * w // sum(CASE WHEN full_ THEN 0 ELSE w END) OVER ({parent}) END AS budget
  FROM f_{level})"""


def _weights_sql(level: str) -> str:
    return f"CASE {level} " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in MIX_WEIGHTS[level].items()) + " ELSE 1 END"


MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce('d' || CAST(TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) % 4 AS VARCHAR), '') AS domain, coalesce(lang, '') AS lang,
         coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM documents),
leaf AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
{_mix_level("domain", "", _weights_sql("domain"))},
{_mix_level("lang", "domain", _weights_sql("lang"))},
{_mix_level("source", "lang", "1")},
g AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole, CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
  FROM leaf JOIN b_source USING (domain, lang, source)),
r AS (SELECT doc_id, d.domain, d.lang, d.source, n_tokens, whole, rest, sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source
    ORDER BY md5('{MIX_SEED}:' || CAST(whole AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)), doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM d JOIN g USING (domain, lang, source)),
c AS (SELECT *, whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(copies AS BIGINT) AS copies FROM c WHERE copies > 0
"""


@query("op9_hierarchical_mix", MIX_SQL)
def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document; documents it does not take are left out."""
    levels = mix_levels()
    rows, leaves = mixing.plan(table(spark, sf_dir, "documents"), levels, MIX_WEIGHTS, MIX_EPOCHS, seed=MIX_SEED)
    return mixing.copies(rows, leaves, list(levels), MIX_SEED).select("doc_id", *levels, "n_tokens", "copies")


LINE_SQL = """
WITH l AS (
  SELECT doc_id, i, x, list_transform(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+'), lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
p AS (SELECT *, row_number() OVER (ORDER BY doc_id, i) AS pos FROM l),
f AS (SELECT w, min(pos) AS first FROM p WHERE len(w) > 0 GROUP BY w),
v AS (SELECT w, first, i, list_concat(w[1:i - 1], w[i + 1:]) AS v FROM (SELECT w, first, unnest(range(1, len(w) + 1)) AS i FROM f WHERE len(w) >= 5)),
s AS (SELECT w, first, min(first) OVER (PARTITION BY v, i) AS other FROM v),
n AS (
  SELECT w FROM s WHERE other < first
  UNION SELECT CASE WHEN v.first > f.first THEN v.w ELSE f.w END FROM v JOIN f ON f.w = v.v WHERE len(f.w) >= 5),
k AS (SELECT p.*, len(p.w) > 0 AND (f.first < p.pos OR n.w IS NOT NULL) AS gone FROM p LEFT JOIN f ON p.w = f.w LEFT JOIN n ON p.w = n.w)
SELECT doc_id, count(*) FILTER (len(w) > 0) AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
FROM k GROUP BY doc_id
"""


@query("op5_line_dedup", LINE_SQL)
def deduped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that an earlier line repeats, up to one edited word."""
    return line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "text")


@query("op1_suffix_tree")
def language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and suffix-tree scores of every document; a seventh by the id's checksum is held out."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return suffix_tree.score_texts(table(spark, sf_dir, "documents"), held)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_collocations", f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS x FROM documents),
p AS (SELECT lang, regexp_extract_all(x, '[^\\x20\\x09]+') AS w FROM d),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS (SELECT lang, s, phrase, count(*) AS f FROM (
    SELECT lang, s, array_to_string(w[i:i + s - 1], ' ') AS phrase FROM (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM p, (VALUES (1), (2), (3)) AS sizes(s)))
  GROUP BY lang, s, phrase HAVING count(*) >= 10),
c AS (SELECT lang, s, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE s > 1),
i AS (SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM c WHERE s = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE s = 3) GROUP BY lang, phrase),
k AS (SELECT c.*, unnest(range(1, s)) AS k FROM c LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR s = 3 OR 100 * longer < 50 * a),
u AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r, CAST((CAST(1000000 AS HUGEINT) * k.a * k.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM k JOIN f AS l ON l.lang = k.lang AND l.phrase = array_to_string(w[1:k.k], ' ') JOIN f AS r ON r.lang = k.lang AND r.phrase = array_to_string(w[k.k + 1:], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS best FROM u),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b WHERE best = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN t USING (lang) WHERE rank <= 2000
""")
def best_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two and three words in each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_spelling", f"""
WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), n)) AS crc),
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, {_LOWER.format("unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+'))")} AS w FROM documents),
g AS (SELECT id, w, count(*) AS n, hex(encode(id || ':' || w)) AS x FROM r GROUP BY id, w),
h AS (SELECT w, n, xor(4294967295, list_reduce(list_transform(range(1, length(x), 2), lambda i: CAST('0x' || x[i:i + 1] AS BIGINT)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) AS h FROM g, t),
a AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM a WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
e AS (SELECT x.word, y.word AS other, y.n FROM d x JOIN d y ON x.d = y.d AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM d x JOIN v y ON x.d = y.word UNION SELECT y.word, x.word, x.n FROM d x JOIN v y ON x.d = y.word),
b AS (SELECT word, count(*) AS n_near, max(n) AS most FROM e GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * v.n THEN (SELECT min(other) FROM e WHERE e.word = v.word AND e.n = most) END AS form,
  CASE WHEN most >= 5 * v.n THEN most END AS form_n FROM v LEFT JOIN b USING (word)),
o AS (WITH RECURSIVE c(word, last) AS (SELECT word, word FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.last WHERE f.form IS NOT NULL)
  SELECT c.word, c.last FROM c JOIN f ON f.word = c.last WHERE f.form IS NULL)
SELECT word, form, last AS root, n, n_near, form_n FROM f JOIN o USING (word)
""")
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents, some altered by the checksum of id and word, with their near words, forms and roots."""
    return spelling.variants(table(spark, sf_dir, "documents"), every=199)


@query("op12_winnowing", f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
m AS (SELECT item, w, least(len(w), 10) AS size FROM b WHERE len(w) > 0),
i AS (SELECT DISTINCT item, size, array_to_string(w[p:p + size - 1], ' ') AS x FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM m)),
s AS (SELECT DISTINCT size FROM m),
x AS (SELECT r, size, p, array_to_string(w[p:p + size - 1], ' ') AS x FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, s)),
h AS (SELECT r, size, p, item FROM x JOIN i USING (size, x)),
n AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(p, p + size)) AS place FROM (SELECT DISTINCT r, p, size FROM h)) GROUP BY r),
k AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN k USING (r)
""")
def contaminated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie inside ten-word windows of benchmark items, and these items."""
    found = winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")
