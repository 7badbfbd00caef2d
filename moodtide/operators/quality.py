"""Data-quality checks as rows.

Every check is one row ``(seq, check, scope, severity, violations, elements, passed)``. Checks on one table are
gathered into a single aggregation, so a table is scanned once however many rules it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide import config

ERROR, WARN = "error", "warn"
CHECK_COLUMNS = ["seq", "check", "scope", "severity", "violations", "elements", "passed"]


class QualityError(ValueError):
    """A check of severity ``error`` failed."""


@dataclass(frozen=True)
class Rule:
    """``violations`` and ``elements`` are aggregates; ``mostly`` is the share of elements that has to pass."""
    seq: int
    check: str
    scope: str
    violations: Column
    elements: Column
    severity: str = ERROR
    mostly: float = 1.0


def not_null(seq: int, table: str, column: str, severity: str = ERROR) -> Rule:
    return Rule(seq, "not_null", f"{table}.{column}", F.count_if(F.col(column).isNull()), F.count(F.lit(1)), severity)


def not_empty(seq: int, table: str) -> Rule:
    return Rule(seq, "not_empty", table, F.when(F.count(F.lit(1)) == 0, 1).otherwise(0), F.count(F.lit(1)))


def satisfies(seq: int, check: str, scope: str, condition: Column, severity: str = ERROR, mostly: float = 1.0,
              where: Column | None = None) -> Rule:
    """Rows where ``condition`` is false; null means the rule does not apply to the row."""
    where = F.lit(True) if where is None else where
    return Rule(seq, check, scope, F.count_if(where & ~F.coalesce(condition, F.lit(True))),
                F.count_if(where & condition.isNotNull()), severity, mostly)


def run_rules(df: DataFrame, rules: Sequence[Rule], skip_empty: bool = False) -> DataFrame:
    """All rules of one table in one pass, then one row per rule."""
    totals = df.agg(*[F.struct(r.violations.cast("bigint").alias("v"), r.elements.cast("bigint").alias("e"))
                      .alias(f"r{i}") for i, r in enumerate(rules)])
    rows = [F.struct(
        F.lit(r.seq).alias("seq"), F.lit(r.check).alias("check"), F.lit(r.scope).alias("scope"),
        F.lit(r.severity).alias("severity"), F.lit(r.mostly).alias("mostly"),
        F.col(f"r{i}.v").alias("violations"), F.col(f"r{i}.e").alias("elements")) for i, r in enumerate(rules)]
    out = totals.select(F.inline(F.array(*rows)))
    if skip_empty:
        out = out.where("elements > 0")
    passed = F.when(F.col("elements") == 0, F.col("violations") == 0).otherwise(
        (F.col("elements") - F.col("violations")) / F.col("elements") >= F.col("mostly"))
    return out.select("seq", "check", "scope", "severity", "violations", "elements", passed.alias("passed"))


def counted(seq: int, check: str, scope: str, bad: DataFrame, severity: str = ERROR) -> DataFrame:
    """A check whose violations are the rows of a DataFrame (duplicates, orphans)."""
    return bad.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(seq).alias("seq"), F.lit(check).alias("check"), F.lit(scope).alias("scope"),
        F.lit(severity).alias("severity"), "violations", F.col("violations").alias("elements"),
        (F.col("violations") == 0).alias("passed"))


def unique(seq: int, df: DataFrame, table: str, column: str) -> DataFrame:
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counted(seq, "unique", f"{table}.{column}", repeated)


def enforce(checks: DataFrame) -> DataFrame:
    """Raise on the first failed error check in listed order. At most one row reaches the driver."""
    first = checks.where("severity = 'error' AND NOT passed").orderBy("seq").head(1)
    if first:
        raise QualityError(f"{first[0]['check']} failed on {first[0]['scope']}: {first[0]['violations']} rows")
    return checks


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- row contract ---------------------------------------------------------------------------
#: Names of what may be wrong with a parsed article.
REASONS = ["title", "content", "url", "push_count", "published_at", "comments"]


def contract_reasons(as_of: Column) -> Column:
    """Why a parsed article may not be stored; an empty array means it is fine."""
    c = F.col
    rules = [
        ("title", c("title").isNull() | (F.regexp_replace(c("title"), r"[\s\p{Z}]+", "") == "")),
        ("content", c("content").isNull()),
        ("url", c("url").isNull() | ~c("url").rlike(r"^https?://")),
        ("push_count", c("push_count").isNotNull() & ~c("push_count").between(-100, 100)),
        ("published_at", c("published_at").isNull() | (c("published_at") > as_of)),
    ]
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def comment_contract() -> Column:
    """True when every nested comment has all of its texts."""
    return F.forall(F.coalesce(F.col("comments"), F.array()), lambda x: (
        x["author"].isNotNull() & x["push_tag"].isNotNull() & x["message"].isNotNull()))


def validate_articles(articles: DataFrame, as_of: Column) -> DataFrame:
    reasons = contract_reasons(as_of)
    if "comments" in articles.columns:
        reasons = F.when(comment_contract(), reasons).otherwise(F.array_append(reasons, F.lit("comments")))
    return articles.withColumn("reasons", reasons).withColumn("valid", F.size("reasons") == 0)


# -- checks on the relational layer ------------------------------------------------------------
def table_checks(articles: DataFrame, comments: DataFrame, scores: DataFrame, sources: DataFrame,
                 tw_prices: DataFrame, us_prices: DataFrame) -> DataFrame:
    """The checks that have to hold before scoring and the warehouse load."""
    named = articles.join(sources.select("source_id", "source_name", "has_push_count"), "source_id", "left")
    push_rules = [
        Rule(20 + i, "push_count_not_null", name,
             F.count_if((F.col("source_name") == name) & F.col("push_count").isNull()),
             F.count_if(F.col("source_name") == name))
        for i, name in enumerate(config.crawled(has_push_count=True))]
    article_rules = [not_empty(2, "articles"), *[
        not_null(10 + i, "articles", c) for i, c in enumerate(["title", "content", "url", "published_at"])], *push_rules]
    ids = articles.select("article_id")
    return union_all([
        run_rules(sources, [not_empty(1, "sources")]),
        run_rules(named, article_rules),
        counted(3, "unique", "articles.url",
                articles.groupBy("url").agg(F.count(F.lit(1)).alias("n")).where("n > 1")),
        counted(30, "orphans", "comments", comments.join(ids, "article_id", "left_anti")),
        run_rules(comments, [not_null(31 + i, "comments", c) for i, c in enumerate(["author", "push_tag", "message"])]),
        counted(40, "orphans", "sentiment_scores", scores.join(ids, "article_id", "left_anti")),
        run_rules(scores, [not_null(41, "sentiment_scores", "score")]),
        run_rules(tw_prices, [not_empty(50, "stock_prices"), not_null(51, "stock_prices", "trade_date"),
                              not_null(52, "stock_prices", "close")]),
        run_rules(us_prices, [not_empty(60, "us_stock_prices"), not_null(61, "us_stock_prices", "trade_date"),
                              not_null(62, "us_stock_prices", "close"),
                              not_null(63, "us_stock_prices", "change", WARN)]),
    ])


def expectations(articles: DataFrame, sources: DataFrame, us_prices: DataFrame) -> DataFrame:
    """Softer expectations with counts and percentages; they report and never abort."""
    c = F.col
    named = articles.join(sources.select("source_id", "source_name"), "source_id")
    rules = [not_null(1, "all", "title"), not_null(2, "all", "url")]
    seq = 10
    for name, s in config.SOURCES.items():
        here = c("source_name") == name
        rules.append(satisfies(seq, "url_pattern", name, c("url").rlike(f"^.*{s['url_pattern']}"), where=here))
        if s["has_push_count"]:
            rules.append(Rule(seq + 1, "push_not_null", name, F.count_if(here & c("push_count").isNull()),
                              F.count_if(here)))
            rules.append(satisfies(seq + 2, "push_range", name, c("push_count").between(-100, 100), where=here))
        seq += 10
    price_rules = [
        not_null(100, "us_stock_prices", "trade_date"), not_null(101, "us_stock_prices", "close"),
        satisfies(102, "close_range", "us_stock_prices", c("close").between(1, 10000)),
        satisfies(103, "change_range", "us_stock_prices", c("change").between(-100, 100), mostly=0.99)]
    out = union_all([run_rules(named, rules, skip_empty=True), run_rules(us_prices, price_rules, skip_empty=True)])
    return out.withColumn("percent", F.col("violations") * 100.0 / F.col("elements"))


def diagnose(articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Articles with missing fields and which ones. All of them, not a batch."""
    fields = ["title", "content", "published_at"]
    bad = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]))
    return (articles.where(" OR ".join(f"{f} IS NULL" for f in fields))
            .join(sources.select("source_id", "source_name"), "source_id")
            .select("article_id", "url", "source_name", bad.alias("bad_fields")))


# -- marts ------------------------------------------------------------------------------------
# --- fixed values: columns a mart has to offer ------------------------------------------------
MART_COLUMNS = {
    "mart_daily_summary": ["summary_date", "source_name", "total_articles", "scored_articles", "avg_sentiment", "avg_push_count"],
    "mart_market_summary": ["fact_date", "market_code", "source_count", "total_articles", "avg_sentiment", "avg_push_count"],
}
# ----------------------------------------------------------------------------------------------


def mart_checks(fact: DataFrame, daily: DataFrame, market: DataFrame) -> DataFrame:
    """What has to hold after a refresh: every fact group is in the mart once, known markets only, columns complete."""
    groups = fact.groupBy("fact_date", "source_name").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("fact_date").alias("summary_date"), "source_name")
    missing = {name: [c for c in MART_COLUMNS[name] if c not in df.columns]
               for name, df in (("mart_daily_summary", daily), ("mart_market_summary", market))}
    columns = [Rule(4 + i, "columns", name, F.lit(len(gone)), F.lit(len(MART_COLUMNS[name])))
               for i, (name, gone) in enumerate(missing.items())]
    return union_all([
        counted(1, "groups_missing", "mart_daily_summary", groups.join(daily, ["summary_date", "source_name"], "left_anti")),
        counted(2, "groups_repeated", "mart_daily_summary",
                daily.groupBy("summary_date", "source_name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")),
        run_rules(market, [satisfies(3, "accepted_values", "mart_market_summary.market_code",
                                     F.col("market_code").isin([code for _, code, *_ in config.MARKETS])), *columns])])
