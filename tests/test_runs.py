"""The scheduled run, serving bounds and settings."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from moodtide.plans import daily_run, serving


def test_optional_steps_may_fail():
    seen = []
    steps = {n: (lambda n=n: seen.append(n)) for n in daily_run.STEPS}
    steps["pii"] = lambda: 1 / 0
    results = daily_run.run(steps)
    assert [r.step for r in results] == list(daily_run.STEPS)
    assert [r.step for r in results if r.status == "failure"] == ["pii"] and "dw_etl" in seen


@pytest.mark.parametrize("step", ["transform", "dw_etl"])
def test_required_steps_end_the_run(step):
    seen = []
    steps = {n: (lambda n=n: seen.append(n)) for n in daily_run.STEPS}
    steps[step] = lambda: 1 / 0
    with pytest.raises(daily_run.RunAborted):
        daily_run.run(steps)
    assert "predict" not in seen


def test_run_log(spark):
    log = daily_run.run_log(spark, daily_run.run({"schema": lambda: None}))
    assert [(r["step"], r["status"]) for r in log.collect()] == [("schema", "success")]


@pytest.fixture
def mart(spark):
    rows = [(date(2024, 1, 1), "a", 100, 100, "0.5000"), (date(2024, 1, 2), "a", 80, 80, "0.3000")]
    return spark.createDataFrame(rows, "summary_date date, source_name string, total_articles long, scored_articles long, s string").select(
        "summary_date", "source_name", "total_articles", "scored_articles", F.col("s").cast("decimal(6,4)").alias("avg_sentiment"))


def test_service_figures(mart):
    day = F.lit("2024-01-02").cast("date")
    assert tuple(serving.sentiment_today(mart, day).head()) == (date(2024, 1, 2), 0.3)
    assert serving.sentiment_change(mart, day).head()[0] == -0.2
    assert tuple(serving.sentiment_recent(mart, day, 10).head()) == (10, 0.41)
    assert serving.sentiment_change(mart, F.lit("2024-01-01").cast("date")).count() == 0
    assert serving.sentiment_today(mart, F.lit("2023-01-01").cast("date")).count() == 0
    assert serving.sentiment_recent(mart, F.lit("2023-01-01").cast("date")).count() == 0
    assert [r["summary_date"].day for r in serving.daily_sentiment(mart, day, 1).collect()] == [2]


@pytest.mark.parametrize("call", [
    lambda m: serving.sentiment_recent(m, F.current_date(), 31), lambda m: serving.sentiment_recent(m, F.current_date(), 0),
    lambda m: serving.top_push(m, limit=101), lambda m: serving.top_push(m, period=366)])
def test_bounds(mart, call):
    with pytest.raises(ValueError):
        call(mart)


def test_search_is_literal_and_null_safe(spark):
    df = spark.createDataFrame([("A.B up", None), ("axb", 3), (None, 4)], "Title string, Push_count int").withColumn(
        "Published_Time", F.lit(None)).withColumn("Url", F.lit("u"))
    assert [(r["Title"], r["Push_count"]) for r in serving.search(df, "a.b").collect()] == [("A.B up", 0)]


def test_headline_without_the_day_before(spark):
    board = spark.createDataFrame([(date(2024, 1, 1), 0.5), (date(2024, 1, 3), 0.25)], "Date date, Article_Sentiment_Score double")
    assert tuple(serving.dashboard_headline(board).head()) == (date(2024, 1, 3), 0.25, 0.0)
