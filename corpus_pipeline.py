"""A training corpus from documents: stages over the operators of ``moodtide.llm``, each a table that the next one reads.

1. ``toxicity``: documents that the string-kernel machine scores 0.5 or more go. It learns from all ``labels``' training rows.
2. ``line_dedup``: lines that repeat an earlier line, up to one edited word, are taken out of the texts; no document goes.
3. ``near_dedup``: of documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, directly or by others, the one of the smallest id
   stays. SimHash fingerprints within three bits propose links, whole sets verify them; an exact join of the shingles finds the rest.
4. ``mix``: documents are taken as often as the budgets of the domain, language and source tree say.
5. ``packing``: the documents' token pieces with their places in sequences of 1024 ids.

All stages but the last return the columns of ``documents``; ``n_chars`` follows the text. An empty table passes through all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.llm import best_fit, line_dedup, mixing, queries, shingle_join, simhash, string_kernel
from moodtide.session import shared_dir


def _free(name: str, docs: DataFrame) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; null texts score like empty ones and stay null. Rows that repeat are scored one by one; any further columns pass as they are."""
    model = string_kernel.fit(docs, queries.table(spark, sf_dir, "labels"))
    score = _free("_score_", docs)
    return string_kernel.scored(docs, model, name=score).filter(F.col(score) < 0.5).select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; a text of repeated lines alone becomes empty and stays a row.

    Of lines that are near each other the one of the smallest id, then of the smaller text hash and the earlier line stays; rows that repeat id and text keep the same lines.
    A null text becomes an empty one. Columns that are called like the operator's counts pass as they are.
    """
    aside = {c: _free(f"_{c}_", docs) for c in docs.columns if c.lower() in ("n_lines", "n_removed")}
    lined = line_dedup.line_dedup(docs.withColumnsRenamed(aside)).drop("n_lines", "n_removed").withColumnsRenamed({v: k for k, v in aside.items()})
    return lined.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: that of the smallest id, then of the smallest text hash, and the smallest of rows that repeat both.

    The choice is made on narrow rows. Only repeated rows are aggregated whole, inside their partitions first.
    """
    folder, marked = shared_dir(spark, "chosen"), shared_dir(spark, "fingerprints")
    simhash.fingerprints(docs, words=5).select("mark", "fp").write.parquet(marked)
    marks = spark.read.parquet(marked).distinct()
    near = simhash.links(marks.select("fp").distinct(), radius=3)
    found = shingle_join.near_duplicates(docs, words=5, fingerprints=marks, near=near)
    best = found.groupBy("root", "id", "mark").agg(F.count(F.lit(1)).alias("rows")).groupBy("root").agg(F.min(F.struct("id", "mark", "rows")).alias("c"))
    best.select("c.*").write.parquet(folder)
    chosen = spark.read.parquet(folder)
    mark = simhash.text_mark("text")
    here = lambda rows: docs.join(rows, docs["doc_id"].eqNullSafe(rows["id"]) & (mark == rows["mark"]), "left_semi")
    repeated = here(chosen.filter("rows > 1")).groupBy("doc_id", mark.alias("_mark_")).agg(F.min(F.struct(*docs.columns)).alias("_row_"))
    return here(chosen.filter("rows = 1")).select(docs.columns).unionByName(repeated.select("_row_.*"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their leaf's budget takes them. A null domain, language or source is a node of its own, a null text has no tokens; rows that repeat an id
    are drawn one by one."""
    return mixing.mixed(docs, queries.mix_levels(), queries.MIX_WEIGHTS, queries.MIX_EPOCHS, seed=queries.MIX_SEED)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and places; a document that was taken twice is packed twice, a null text is the end id alone."""
    placed = best_fit.pack(docs, shared_dir(spark, "pieces"), queries.BYTE_VOCABULARY, end=2, capacity=1024)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("line_dedup", dedup_lines), ("near_dedup", near_dedup), ("mix", mix), ("packing", packing)]

#: No SQL can train the classifier of the first stage or encode the ids of the last; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark, "corpus")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
