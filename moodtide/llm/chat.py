"""Reply trees as training conversations, in DataFrame functions only.

Messages form trees. Narrow key rows (tree, message, parent, score) are joined with themselves again and again, each time over twice the distance,
until every message knows its root, depth and the scores above it. Messages without a reply end the branches. These are ranked by the sum of
their scores, and the messages of the best of each tree become a conversation. Texts join at the very end, once.

Template: ``<|role|>``, a line break, the text, ``</s>``, a line break; for each turn. In roles and texts a backslash follows every
``<``, ``[``, ``|`` and backslash, so that no control string can stand there, and one pass of a pattern takes them out again. The loss mask
is a list of code point spans, one for each assistant text.

Defined cases: null roles and texts are empty; null tree ids are one tree of their own; null turns come first; rows without a message id are no
messages; a message whose parent is null or missing is a root; of rows that repeat (tree, message) the smallest (parent, score) and the
smallest (role, text) count, while :func:`chains` numbers repeated turns one after the other; loops have no root and give no branch; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.session import shared_dir

END = "</s>\n"
_OPEN, _CLOSE = "<|", "|>\n"


def escape(text: Column) -> Column:
    """No ``<``, ``[``, ``|`` is left without a backslash behind it."""
    return F.regexp_replace(text, r"([<\[|\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[|\\])\\", "$1")


def chains(rows: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages ``tree, message, parent, score, role, text`` of a table of turns: each turn answers the one before."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = rows.select(F.col(tree).alias("tree"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("message", F.row_number().over(order).cast("bigint"))
    return rows.select("tree", "message", F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def branches(messages: DataFrame, keep: int = 1) -> DataFrame:
    """``tree, branch, score, place, message``: the messages of the ``keep`` best root-to-leaf paths of each tree, ties to the smaller last message.

    ``messages`` must be a written table. Pointers are joined with themselves: after round k each message points 2^k messages up and holds the
    score in between, so the rounds grow with the logarithm of the longest path. The chosen leaves then walk the same
    pointers, the longest first, which meets every message of a path once. Every round is written to the shared folder, so a lost executor costs one round.
    """
    spark = messages.sparkSession
    folder = shared_dir(spark, "paths")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    same = lambda a, b: F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree"))
    keys = written(messages.filter("message IS NOT NULL").groupBy("tree", "message").agg(
        F.min(F.struct("parent", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("m")).select("tree", "message", "m.parent", "m.score"), "keys")
    known = keys.alias("k").join(keys.select("tree", "message").alias("p"), same("k", "p") & (F.col("k.parent") == F.col("p.message")), "left")
    first = known.select("k.tree", "k.message", F.col("p.message").alias("up"), F.when(F.col("p.message").isNotNull(), 1).otherwise(0).cast("bigint").alias("place"), "k.score")
    pointers = [written(first, "up-0")]
    while len(pointers) <= keys.count().bit_length() and not pointers[-1].filter("up IS NOT NULL").isEmpty():  # what still points up then is in a loop
        now = pointers[-1]
        further = now.alias("j").join(now.alias("o"), same("j", "o") & (F.col("j.up") == F.col("o.message")), "left").select(
            "j.tree", "j.message", "o.up", (F.col("j.place") + F.coalesce("o.place", F.lit(0))).alias("place"), (F.col("j.score") + F.coalesce("o.score", F.lit(0.0))).alias("score"))
        pointers.append(written(further, f"up-{len(pointers)}"))
    rooted = pointers[-1].filter("up IS NULL").select("tree", "message", "place", "score")
    inner = pointers[0].filter("up IS NOT NULL").select("tree", F.col("up").alias("message")).distinct()
    leaves = rooted.alias("l").join(inner.alias("i"), same("l", "i") & (F.col("l.message") == F.col("i.message")), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "message")
    steps = leaves.withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= keep).select("tree", "branch", "score", "place", "message")
    for k in range(len(pointers) - 2, -1, -1):
        steps = written(steps, f"steps-{k}")
        up = pointers[k].filter("up IS NOT NULL").select("tree", "message", "up")
        above = steps.alias("s").join(up.alias("u"), same("s", "u") & (F.col("s.message") == F.col("u.message"))).select(
            "s.tree", "s.branch", "s.score", (F.col("s.place") - 2 ** k).alias("place"), F.col("u.up").alias("message"))
        steps = steps.unionByName(above)
    return steps


def conversations(messages: DataFrame, keep: int = 1, trained: str = "assistant") -> DataFrame:
    """``tree, branch, formatted, loss_spans``: the best branches of each tree as formatted texts with their loss masks."""
    steps = branches(messages, keep)
    texts = messages.groupBy("tree", "message").agg(F.min(F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("m")).select("tree", "message", "m.role", "m.text")
    rows = steps.alias("s").join(texts.alias("t"), F.col("s.tree").eqNullSafe(F.col("t.tree")) & (F.col("s.message") == F.col("t.message")))
    turn = F.struct(F.col("s.place").alias("place"), F.col("t.role").alias("role"), F.col("t.text").alias("text"))
    told = rows.groupBy("s.tree", "s.branch").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    heads = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(_OPEN), escape(t["role"]), F.lit(_CLOSE)).alias("head"), escape(t["text"]).alias("body"), (t["role"] == trained).alias("train")))
    told = told.select("tree", "branch", heads.alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    length = lambda c: F.length(c).cast("bigint")
    spans = F.aggregate("turns", zero, lambda a, t: F.struct(
        (a["at"] + length(t["head"]) + length(t["body"]) + F.lit(len(END))).alias("at"),
        F.when(t["train"], F.concat(a["spans"], F.array(F.struct((a["at"] + length(t["head"])).alias("start"), length(t["body"]).alias("length")))))
        .otherwise(a["spans"]).alias("spans")), lambda a: a["spans"])
    return told.select("tree", "branch", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of a formatted conversation."""
    turns = F.filter(F.split(formatted, END, -1), lambda t: t != "")
    head = lambda t: F.locate(_CLOSE, t)
    return F.transform(turns, lambda t: F.struct(
        unescape(F.substring(t, F.lit(len(_OPEN) + 1), head(t) - F.lit(len(_OPEN) + 1))).alias("role"),
        unescape(F.substring(t, head(t) + F.lit(len(_CLOSE)), F.length(t))).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
