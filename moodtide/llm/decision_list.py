"""Quality rules as a learned decision list over statistics of whole texts, in DataFrame functions only.

Sequential covering on labelled rows: a rule for low quality grows by the threshold condition of the highest information gain, is
pruned back on rows held out for it, and its rows leave the data; then the next rule grows. The list becomes one ordered
conditional expression. The rows never leave Spark: each step reads counts of a histogram (feature x threshold x label), whose size
does not depend on the data.

Defined cases: a null text has no words (it fails the base rule); rows that repeat an id are judged one by one; an id with several labels counts
as its lowest; labels without a document, null labels and null ids are not learned from; without labels, or with one class only, the list
is empty and keeps all; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.session import shared_dir

WINDOW = 5
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Ratios the rules look at; numerators and denominators are whole numbers of :func:`statistics`.
FEATURES = {
    "mean_word": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"), "capitals": ("n_capitals", "word_chars"), "exclaims": ("n_exclaims", "n_words"),
    "different": ("n_different", "n_words"),
}
#: Thresholds tried for a feature: quantiles of all and of the low rows.
QUANTILES = 24


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and counts of every whole text. Windows of five words are compared by a 64-bit hash inside their text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("solid", F.btrim("text", F.lit(_SPACES)))
    rows = rows.select(
        "doc_id", "text",
        F.when(F.col("solid") == "", F.array().cast("array<string>")).otherwise(F.split("solid", "[\\x20\\x09-\\x0D]+")).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(_SPACES))) > 0).alias("lines"))
    n = F.size("words")
    word = lambda i: F.get("words", i)
    windows = F.when(n > WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[word(i + k) for k in range(WINDOW)])))
    rows = rows.select(
        "doc_id", n.cast("bigint").alias("n_words"), F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.length(F.translate("text", _SYMBOLS, "")).alias("plain"), F.length("text").alias("size"),
        F.length(F.translate("text", _CAPITALS + "!", "")).alias("lower"), F.length(F.replace("text", F.lit("!"), F.lit(""))).alias("calm"),
        F.size("lines").alias("n_lines"), F.size(F.array_distinct("lines")).alias("different_lines"), F.size(F.array_distinct("words")).alias("n_different"),
        windows.alias("windows"))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.when(twice, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("placed", placed).drop("windows")
    at = lambda i: F.get("placed", i)["h"]
    again = F.filter("placed", lambda p, j: p["h"].eqNullSafe(at(j - 1)) | p["h"].eqNullSafe(at(j + 1)))
    rows = rows.withColumn("again", F.sort_array(F.transform(again, lambda p: p["i"]))).drop("placed")
    covered = F.aggregate("again", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum")), lambda s, i: F.struct(
        i.alias("last"), (s["sum"] + F.least(F.lit(WINDOW), i - s["last"])).alias("sum")), lambda s: s["sum"])
    count = lambda c: c.cast("bigint")
    return rows.select(
        "doc_id", "n_words", "word_chars", count(F.col("size") - F.col("plain")).alias("n_symbols"),
        count(F.col("n_lines") - F.col("different_lines")).alias("n_dup_lines"), count(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"),
        count(F.col("n_lines")).alias("n_lines"), count(F.col("calm") - F.col("lower")).alias("n_capitals"), count(F.col("size") - F.col("calm")).alias("n_exclaims"),
        count(F.col("n_different")).alias("n_different"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def feature(name: str) -> Column:
    top, below = FEATURES[name]
    return F.coalesce(F.try_divide(F.col(top), F.col(below)), F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    """``feature >= at``, or ``feature < at``."""

    feature: str
    above: bool
    at: float

    def column(self) -> Column:
        return feature(self.feature) >= self.at if self.above else feature(self.feature) < self.at


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a row that meets a rule is rejected, a row that meets none is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def kept(self) -> Column:
        out = None
        for rule in self.rules:
            whole = F.lit(True)
            for condition in rule:
                whole = whole & condition.column()
            out = F.when(whole, F.lit(False)) if out is None else out.when(whole, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def __str__(self) -> str:
        said = [" and ".join(f"{c.feature} {'>=' if c.above else '<'} {c.at:.4g}" for c in rule) for rule in self.rules]
        return "; ".join(f"reject if {s}" for s in said) or "keep all"


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -math.inf


def learn(labelled: DataFrame, low: Column, seed: Column, precision: float = 0.9, least: int = 5, most_rules: int = 12, most_conditions: int = 4) -> DecisionList:
    """Rules for rows where ``low`` holds; a third of the rows by ``seed`` prunes. A rule must be right for ``precision`` of the rows it meets."""
    values = labelled.select(*[feature(f).alias(f) for f in FEATURES], low.alias("low"), (F.pmod(F.xxhash64(seed), F.lit(3)) > 0).alias("grow"))
    shares = [(i + 0.5) / QUANTILES for i in range(QUANTILES)]
    cuts_of = values.agg(*[F.percentile_approx(f, shares, 2000).alias(f"all_{f}") for f in FEATURES],
                         *[F.percentile_approx(F.when(F.col("low"), F.col(f)), shares, 2000).alias(f"low_{f}") for f in FEATURES]).first()
    cuts = {f: sorted({x for kind in ("all", "low") for x in (cuts_of[f"{kind}_{f}"] or [])}) for f in FEATURES}
    names = [f for f in FEATURES if cuts[f]]
    if not names:
        return DecisionList(())
    # number of thresholds at or below the value: all any condition can tell
    level = lambda f: F.aggregate(F.array(*[F.lit(t) for t in cuts[f]]), F.lit(0), lambda a, t: a + (t <= F.col(f)).cast("int"))
    folder = shared_dir(labelled.sparkSession, "levels")
    values.groupBy(*[level(f).alias(f) for f in names], "low", "grow").agg(F.count(F.lit(1)).alias("n")).write.parquet(folder)
    cells = labelled.sparkSession.read.parquet(folder)

    def inside(rule: tuple) -> Column:
        out = F.lit(True)
        for f, above, i in rule:
            out = out & ((F.col(f) > i) if above else (F.col(f) <= i))
        return out

    def counts(rows: DataFrame) -> dict[tuple[str, bool, bool], list[int]]:
        """Rows by feature, label and part, for each level; a few hundred numbers."""
        long = rows.select("low", "grow", "n", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("i")) for f in names])).alias("x"))
        out = {(f, a, b): [0] * (len(cuts[f]) + 1) for f in names for a in (False, True) for b in (False, True)}
        for r in long.groupBy("x.f", "x.i", "low", "grow").agg(F.sum("n").alias("n")).collect():
            out[r.f, r.low, r.grow][r.i] = r.n
        return out

    rules: list[tuple] = []
    while len(rules) < most_rules:
        rest = cells
        for rule in rules:
            rest = rest.filter(~inside(rule))
        rule: tuple = ()
        judged: list[tuple[float, int, int]] = []  # of each prefix of the rule, on the pruning rows
        while len(rule) < most_conditions:
            now = counts(rest.filter(inside(rule)))
            any_ = names[0]
            p0, n0 = sum(now[any_, True, True]), sum(now[any_, False, True])
            if rule:
                p, n = sum(now[any_, True, False]), sum(now[any_, False, False])
                judged.append(((p - n) / (p + n) if p + n else -1.0, p, n))
            if p0 < least or not n0:
                break
            best = (0.0, None)
            for f in names:
                ps, ns = now[f, True, True], now[f, False, True]
                below_p = below_n = 0
                for i in range(len(cuts[f])):
                    below_p, below_n = below_p + ps[i], below_n + ns[i]
                    for above, p, n in ((True, p0 - below_p, n0 - below_n), (False, below_p, below_n)):
                        if p >= least and (g := _gain(p, n, p0, n0)) > best[0] + 1e-9:
                            best = (g, (f, above, i))
            if best[1] is None:
                break
            rule += (best[1],)
        if len(judged) < len(rule):
            now = counts(rest.filter(inside(rule)))
            p, n = sum(now[names[0], True, False]), sum(now[names[0], False, False])
            judged.append(((p - n) / (p + n) if p + n else -1.0, p, n))
        if not rule:
            break
        length = max(range(len(rule)), key=lambda k: (judged[k][0], -k)) + 1
        _, p, n = judged[length - 1]
        if p < 1 or p < precision * (p + n):
            break
        rules.append(rule[:length])
    return DecisionList(tuple(tuple(Condition(f, above, cuts[f][i]) for f, above, i in rule) for rule in rules))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> tuple[DataFrame, DecisionList]:
    """Statistics of every document with ``base_failed`` and ``kept``, and the list that was learned from the labelled ones that pass the base rule."""
    folder = shared_dir(docs.sparkSession, "statistics")
    statistics(docs, doc_id, text).write.parquet(folder)
    rows = docs.sparkSession.read.parquet(folder)
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).alias("quality")).dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = rows.filter(~base_failed()).join(known, "doc_id")
    rules = learn(labelled, F.col("quality") == 0, F.col("doc_id"))
    judged = rows.withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & rules.kept()), rules
