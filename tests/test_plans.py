"""What the plans of the registered queries may not contain, and what they have to."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from moodtide.functions import urls
from moodtide.functions.once import computed_once
from moodtide.plans import staging, warehouse
from moodtide.sources.domain import Desk

# Queries that write, stream or train while they are built are covered by the plans of their parts.
BUILT_AT_ONCE = {"walk_forward_predict", "score_articles", "text_model_eval", "export_tables", "snapshot_tables", "clustered_fact",
                 "mart_refresh", "prediction_runs", "raw_articles_append", "raw_scores_append", "schema_tests"} | {
    n for n in entry.queries() if n.startswith("stream_")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - BUILT_AT_ONCE))
def test_no_products_of_tables(spark, folder, name):
    plan = plan_of(entry.queries()[name](spark, folder))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_fact_reads_only_what_it_needs(spark, folder):
    desk = Desk(spark, folder)
    plan = plan_of(warehouse.fact_sentiment(desk.articles(), desk.scores(), desk.sources(), warehouse.dim_source(desk.sources())))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert all("props" not in s and "user_id" not in s for s in scans)
    assert "PushedFilters: [IsNotNull(value), GreaterThanOrEqual(value,5.0)" in plan
    # Aggregation, then names: one shuffle of daily rows besides the join of articles and scores.
    assert plan.index("LocalTableScan") > plan.index("Exchange hashpartitioning(fact_date")


def test_payload_is_parsed_once_and_shuffled_once(spark, folder, tmp_path):
    Desk(spark, folder).raw_articles().write.parquet(str(tmp_path / "raw"))
    plan = plan_of(staging.stage_articles(spark.read.parquet(str(tmp_path / "raw"))))
    assert plan.count("from_json(") == 1 and plan.count("Exchange hashpartitioning(url") == 1 and "Join" not in plan


def test_staging_for_the_fact_shuffles_no_texts(spark, folder, tmp_path):
    Desk(spark, folder).raw_articles().write.parquet(str(tmp_path / "raw"))
    staged = staging.stage_articles(spark.read.parquet(str(tmp_path / "raw")), ["url", "source_name", "scraped_at"])
    plan = plan_of(staged)
    assert "content" not in plan and "title" not in plan and set(staged.columns) == {"url", "source_name", "scraped_at"}


def test_computed_once_blocks_the_copy(spark):
    df = spark.createDataFrame([('{"a":"x"}',)], "j string")
    copied = df.select(F.from_json("j", "a string").alias("p")).where("p.a IS NOT NULL")
    once = computed_once(df, F.from_json("j", "a string").alias("p")).where("p.a IS NOT NULL")
    assert plan_of(copied).count("from_json(") == 2 and plan_of(once).count("from_json(") == 1


def test_canonical_urls_are_stable(spark):
    """Canonical form of a canonical form is itself, for addresses put together from all kinds of parts.

    A path of slashes only is the exception: they are all cut, and an address without path gets one slash.
    """
    part = lambda *xs: F.explode(F.array(*[F.lit(x) for x in xs]))
    df = (spark.range(1).select(part("http", "HTTPS").alias("s")).select("s", part("x.com", "WWW.x.com:80", "u@X.com:443", "x.com:8443").alias("h"))
          .select("*", part("", "/", "/a/", "/A%20b/c//", "/p;v=1", "/p/;").alias("p"))
          .select("*", part("", "?", "?b=1&utm_source=x", "?Ref=1", "?q=a+b&r=%C3%A9&s&&t=", "?x=50%&y=~*").alias("q"))
          .select("*", part("", "#top").alias("f")).select(F.concat("s", F.lit("://"), "h", "p", "q", "f").alias("url")))
    once = df.select(urls.canonical_url(F.col("url")).alias("a")).select("a", urls.canonical_url(F.col("a")).alias("b"))
    assert once.where("a <> b OR a NOT LIKE 'https://%' OR a LIKE '%#%' OR lower(a) LIKE '%utm_source%'").count() == 0
    assert once.count() == 2 * 4 * 6 * 6 * 2
