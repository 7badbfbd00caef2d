"""Mixing sources to target weights by hierarchical budgets over a tree such as domain - language - source.

A node's budget is shared among its children by their weights. A child cannot take more than its tokens times the allowed epochs; what it
leaves is shared among its siblings by weight, again and again, before anything goes back to the parent's siblings: a parent's own limit
is the sum of its leaves. All of it is windows over the node tables, one row a node, in whole-number arithmetic.

A leaf with a budget takes whole epochs of its documents and then, of one more epoch in an order seeded by the epoch, the longest run of documents
from the start that stays within the budget. The order is that of an MD5 key, whose first three digits make 4096 slices: slice sums
tell which slice the budget ends in, and only documents of that slice are added up one by one.

Defined cases: null levels are ``''``, null texts have no tokens, null ids are ordered like the text ``''``; documents without tokens go with the run around them;
repeated rows are each a document, in the order of their sizes and hashes; weights are whole numbers, 1 where none is given, and children of weight 0 get what
nobody else can take: nothing; an empty table gives no rows; other columns pass through :func:`mixed` untouched.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.session import shared_dir

_BIG = "decimal(38,0)"


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def domain_of(source: str = "source") -> Column:
    """Domains of the test tables: the number in a source's name modulo four."""
    return F.coalesce(F.concat(F.lit("d"), (F.regexp_extract(source, "([0-9]+)", 1).try_cast("bigint") % 4).cast("string")), F.lit(""))


def order_key(seed: str, epoch: str, doc_id: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.col(epoch).cast("string"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for value, weight in weights.items():
        out = F.when(F.col(level) == value, F.lit(weight)).otherwise(out)
    return out.cast(_BIG)


def share(nodes: DataFrame, above: Sequence[str], level: str, weights: Mapping[str, int]) -> DataFrame:
    """Children ``(*above, level, most)`` with their parent's ``budget``: the same rows with their own budgets.

    In ascending order of limit over weight a child is full when an even share of what is left would reach its limit. That holds for a first part
    of the children; the rest share what the full ones leave.
    """
    siblings = Window.partitionBy(*above)
    order = siblings.orderBy("_ratio", level)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = nodes.withColumn("_w", _weight(level, weights)).withColumn(
        "_ratio", F.coalesce(F.try_divide(F.col("most").cast("double"), F.col("_w").cast("double")), F.lit(float("inf"))))
    rows = rows.withColumns({
        "_all": F.sum("_w").over(siblings), "_w_before": F.coalesce(F.sum("_w").over(earlier), F.lit(0)).cast(_BIG),
        "_most_before": F.coalesce(F.sum("most").over(earlier), F.lit(0)).cast(_BIG)})
    reaches = F.col("most").cast(_BIG) * (F.col("_all") - F.col("_w_before")) <= F.col("_w") * (F.col("budget").cast(_BIG) - F.col("_most_before"))
    rows = rows.withColumn("_full", F.min(reaches.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    rows = rows.withColumns({
        "_left": F.col("budget").cast(_BIG) - F.sum(F.when(F.col("_full"), F.col("most")).otherwise(0)).over(siblings),
        "_open": F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w"))).over(siblings).cast(_BIG)})
    even = F.when(F.col("_open") > 0, F.expr("CAST(_left * _w AS DECIMAL(38,0)) div CAST(_open AS DECIMAL(38,0))")).otherwise(F.lit(0))
    return rows.select(*above, level, F.when(F.col("_full"), F.col("most")).otherwise(even).cast("bigint").alias("budget"))


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], epochs: int, budget: int | None) -> DataFrame:
    """``(*levels, tokens, budget)`` of every leaf from ``(*levels, tokens)``; the default budget is all tokens once."""
    leaves = leaves.withColumn("most", F.col("tokens") * epochs)
    if budget is None:
        budget = leaves.agg(F.sum("tokens")).first()[0] or 0
    parents = None
    for depth, level in enumerate(levels):
        above = list(levels[:depth])
        nodes = leaves.groupBy(*above, level).agg(F.sum("most").cast("bigint").alias("most"))
        nodes = nodes.join(parents, above) if depth else nodes.withColumn("budget", F.lit(budget).cast("bigint"))
        parents = share(nodes, above, level, weights.get(level, {}))
    return leaves.select(*levels, "tokens").join(parents, list(levels))


def plan(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]], epochs: int = 3, budget: int | None = None,
         seed: str = "mix", doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Narrow rows of all documents, written once, and one row a leaf: whole epochs, budget of the last epoch, slice it ends in, tokens of the slices before."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "mix")
    names = list(levels)
    docs.select(F.col(doc_id).alias("doc_id"), *[F.coalesce(c, F.lit("")).alias(n) for n, c in levels.items()],
                n_words(text).alias("n_tokens"), F.xxhash64(text).alias("mark")).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").cast("bigint").alias("tokens"))
    given = budgets(leaves, names, weights, epochs, budget).select(
        *names, F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).cast("bigint").alias("whole"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).cast("bigint").alias("rest"))
    given.write.parquet(f"{folder}/budgets")
    given = spark.read.parquet(f"{folder}/budgets")
    slice_ = F.substring(order_key(seed, "whole", "doc_id"), 1, 3)
    sizes = rows.join(given, names).groupBy(*names, "rest", slice_.alias("slice")).agg(F.sum("n_tokens").cast("bigint").alias("n"))
    before = (F.sum("n").over(Window.partitionBy(*names).orderBy("slice")) - F.col("n")).cast("bigint")
    ends = sizes.withColumn("before", before).filter(F.col("before") + F.col("n") > F.col("rest")).groupBy(*names).agg(
        F.min(F.struct("slice", "before")).alias("e"))
    given.join(ends, names, "left").select(*names, "whole", "rest", F.col("e.slice").alias("last"), F.col("e.before").alias("before")).write.parquet(f"{folder}/leaves")
    return rows, spark.read.parquet(f"{folder}/leaves")


def copies(rows: DataFrame, leaves: DataFrame, names: Sequence[str], seed: str) -> DataFrame:
    """``rows`` with ``copies``, how often each is taken; rows that are not taken are left out."""
    keyed = rows.join(leaves, list(names)).withColumn("_key", order_key(seed, "whole", "doc_id")).withColumn("_slice", F.substring("_key", 1, 3))
    at_end = F.col("_slice").eqNullSafe(F.col("last"))
    plain = keyed.filter(~at_end).withColumn("copies", F.col("whole") + F.coalesce(F.col("_slice") < F.col("last"), F.lit(False)).cast("bigint"))
    order = Window.partitionBy(*names).orderBy("_key", "doc_id", "n_tokens", "mark").rowsBetween(Window.unboundedPreceding, 0)
    ending = keyed.filter(at_end).withColumn("copies", F.col("whole") + (F.col("before") + F.sum("n_tokens").over(order) <= F.col("rest")).cast("bigint"))
    return plain.unionByName(ending).filter("copies > 0").select(*rows.columns, "copies")


def mixed(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[str, Mapping[str, int]], epochs: int = 3, budget: int | None = None,
          seed: str = "mix", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents themselves with all their columns, each as often as it is taken."""
    _, leaves = plan(docs, levels, weights, epochs, budget, seed, doc_id, text)
    names = [f"_level_{n}" for n in levels]
    leaves = leaves.toDF(*names, *leaves.columns[len(names):])
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("doc_id"),
                        *[F.coalesce(c, F.lit("")).alias(n) for n, c in zip(names, levels.values())], n_words(text).alias("n_tokens"), F.xxhash64(text).alias("mark"))
    taken = copies(inner, leaves, names, seed)
    return taken.select("row.*", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("_copy")).drop("_copy")
