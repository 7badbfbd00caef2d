"""Streams over several files, with late re-deliveries and a repeated run, against the batch result."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from catalog import increments
from catalog.operations import StreamDesk
from moodtide.operators import monitoring
from moodtide.plans import staging, warehouse
from moodtide.plans.ledger import FactLedger
from moodtide.session import shared_dir
from moodtide.sources import domain
from moodtide.sources.domain import Desk
from moodtide.streaming import jobs
from moodtide.streaming.folded import FoldedLog

T0 = datetime(2024, 1, 1)
SCHEMA = "raw_id long, source_name string, raw_payload string, ingested_at timestamp_ntz"


def payload(url, title):
    return f'{{"url":"{url}","title":"{title}","published_at":"2024-01-01"}}'


def test_goes_of_several_files_are_a_batch_each(spark, folder, monkeypatch):
    monkeypatch.setattr(increments, "FILE_ROWS", 20)
    rows = spark.range(200).withColumn("v", F.col("id") * 2)
    stream = increments._as_files(Desk(spark, folder), rows, F.col("id") % 2, 2)
    got = []
    jobs._run(stream, lambda batch, number: got.append(sorted(r.id for r in batch.collect())), shared_dir(spark, "checkpoint"))
    assert got == [list(range(0, 200, 2)), list(range(1, 200, 2))]


def test_streamed_tables_are_spread_like_stored_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(domain, "TASK_ROWS", 20)
    rows = [(i, T0 + timedelta(hours=i), i, "click", float(i % 100), "{}") for i in range(200)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = []
    jobs._run(StreamDesk(spark, str(tmp_path)).raw_articles(), lambda batch, number: got.append((batch.rdd.getNumPartitions(), sorted(batch.collect()))), shared_dir(spark, "checkpoint"))
    assert [r for _, r in got] == [sorted(Desk(spark, str(tmp_path)).raw_articles().collect())] and got[0][0] >= 10


@pytest.fixture
def landed(spark, tmp_path):
    """Three deliveries in three files; u1 comes again late, and once out of order."""
    files = [
        [(1, "cnn", payload("u1", "a"), T0), (2, "cnn", payload("u2", "b"), T0 + timedelta(hours=1))],
        [(3, "cnn", payload("u1", "newer"), T0 + timedelta(hours=30)), (4, "wsj", payload("u3", "c"), T0 + timedelta(hours=30))],
        [(5, "cnn", payload("u1", "older"), T0 + timedelta(hours=2)), (6, "cnn", payload("u4", "d"), T0 + timedelta(hours=31))]]
    folder = str(tmp_path / "raw")
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_staging_equals_batch_and_reruns_add_nothing(spark, landed, tmp_path):
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "cp")
    for _ in range(2):
        jobs.publish_staging(stream(spark, landed), log, checkpoint)
    key = lambda df: sorted((r["url"], r["article_id"], r["title"]) for r in df.collect())
    batch = key(staging.stage_articles(spark.read.parquet(landed)))
    assert key(jobs.current_staging(spark, log)) == batch == [("u1", 1, "newer"), ("u2", 2, "b"), ("u3", 4, "c"), ("u4", 6, "d")]


def test_hourly_counts_equal_batch(spark, landed, tmp_path):
    out = str(tmp_path / "hours")
    jobs.hourly_ingest(stream(spark, landed), out, str(tmp_path / "cp"))
    key = lambda df: sorted((str(r["hour"]), r["source_name"], r["new_articles"]) for r in df.collect())
    assert key(jobs.current_hourly(spark, out)) == key(monitoring.hourly_ingest(spark.read.parquet(landed)))


def test_first_deliveries_are_unique(spark, landed, tmp_path):
    out = str(tmp_path / "urls")
    jobs.first_deliveries(stream(spark, landed), out, str(tmp_path / "cp"))
    assert sorted(r["url"] for r in jobs.first_seen(spark, out).read().collect()) == ["u1", "u2", "u3", "u4"]


def test_fact_recomputes_touched_days_only(spark, tmp_path):
    schema = "article_id long, source_id int, published_at timestamp_ntz, push_count int"
    folder = str(tmp_path / "articles")
    for rows in ([(1, 4, T0, None), (2, 4, T0 + timedelta(days=1), None)], [(3, 4, T0, None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    scores = spark.createDataFrame([(1, 0.5), (2, -0.5)], "article_id long, score double")
    sources = spark.createDataFrame([(4, "cnn", "u")], "source_id int, source_name string, url string")
    log, fact = str(tmp_path / "log"), str(tmp_path / "fact")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    jobs.refresh_fact(source, scores, sources, log, fact, str(tmp_path / "cp"))
    read = lambda: sorted((str(r["fact_date"]), r["article_count"], r["scored_articles"], float(r["avg_sentiment"]))
                          for r in spark.read.parquet(fact).collect())
    assert read() == [("2024-01-01", 2, 1, 0.5), ("2024-01-02", 1, 1, -0.5)]
    late = spark.createDataFrame([(3, -0.5)], "article_id long, score double")
    days = jobs.days_of_scores(spark, log, late)
    assert [str(d) for d in days] == ["2024-01-01"]
    jobs.recompute_days(spark, log, scores.unionByName(late), sources, warehouse.dim_source(sources), days, fact)
    assert read() == [("2024-01-01", 2, 2, 0.0), ("2024-01-02", 1, 1, -0.5)]
    assert spark.read.parquet(fact).select(F.sum("article_count")).head()[0] == 3


def _batches(spark, folder, files, schema):
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_rows_of_any_age_count_and_are_first_deliveries(spark, tmp_path):
    """A file from 400 days before the newest one comes last: back-fills are exactly that."""
    old = T0 - timedelta(days=400)
    files = [[(1, "cnn", payload("u1", "a"), T0)], [(2, "cnn", payload("u2", "b"), T0 + timedelta(days=9))],
             [(3, "cnn", payload("u3", "c"), old), (4, "cnn", payload("u1", "again"), old), (5, "cnn", payload("u3", "c"), old)]]
    raw = _batches(spark, str(tmp_path / "raw"), files, SCHEMA)
    jobs.hourly_ingest(raw, str(tmp_path / "hours"), str(tmp_path / "cp1"))
    assert jobs.current_hourly(spark, str(tmp_path / "hours")).agg(F.sum("new_articles")).head()[0] == 5
    jobs.first_deliveries(raw, str(tmp_path / "urls"), str(tmp_path / "cp2"))
    assert sorted((r["url"], r["raw_id"]) for r in jobs.first_seen(spark, str(tmp_path / "urls")).read().collect()) == [("u1", 1), ("u2", 2), ("u3", 3)]


def test_fact_of_null_days_repeated_and_moved_articles_and_later_scores(spark, tmp_path):
    schema = "article_id long, source_id int, published_at timestamp_ntz, push_count int"
    day = lambda n: T0 + timedelta(days=n)
    folder, log, fact, checkpoint = (str(tmp_path / n) for n in ("articles", "log", "fact", "cp"))
    source = _batches(spark, folder, [[(1, 4, None, 1), (2, 4, day(0), 1)], [(2, 4, day(0), 3), (3, 4, day(1), 1)], [(3, 4, day(2), 1)]], schema)
    sources = spark.createDataFrame([(4, "cnn", "u")], "source_id int, source_name string, url string")
    none = spark.createDataFrame([], "article_id long, score double")
    jobs.refresh_fact(source, none, sources, log, fact, checkpoint)
    read = lambda: sorted((str(r["fact_date"]), r["article_count"], r["scored_articles"]) for r in spark.read.parquet(fact).collect())
    assert read() == [("2024-01-01", 1, 0), ("2024-01-03", 1, 0), ("None", 1, 0)]
    scores = spark.createDataFrame([(1, 0.5), (3, 0.5)], "article_id long, score double")
    jobs.refresh_fact(source, scores, sources, log, fact, checkpoint)  # no new article
    assert read() == [("2024-01-01", 1, 0), ("2024-01-03", 1, 1), ("None", 1, 1)]


# -- folding -------------------------------------------------------------------------------------------
def delivered(spark, rows):
    return spark.createDataFrame(rows, "url string, v string, at long")


def newest(df):
    return df.groupBy("url").agg(F.max_by("v", "at").alias("v"), F.max("at").alias("at"))


def test_log_folds_in_tiers_and_equals_the_whole(spark, tmp_path):
    log = FoldedLog(spark, str(tmp_path / "log"), newest, fan=3)
    everything, rewritten = [], 0
    for b in range(14):
        rows = [(f"u{(7 * b + i) % 30}", f"v{b}", 100 * b + i) for i in range(6)]
        everything += rows
        log.write(delivered(spark, rows), b)
        rewritten += log.compact()
        assert sorted(log.current().collect()) == sorted(newest(delivered(spark, everything)).collect())
        assert len(log.parts()) <= 2 * 3 + 2
    parts = log.parts()
    assert [p[0] for p in parts] == [0] + [p[1] + 1 for p in parts[:-1]] and parts[-1][1] == 13  # every batch once, in order
    assert rewritten < 14


def test_a_replayed_batch_and_readers_of_an_old_generation(spark, tmp_path):
    log = FoldedLog(spark, str(tmp_path / "log"), newest, fan=2)
    for b in range(3):
        log.write(delivered(spark, [(f"u{b}", "a", b)]), b)
    before = log.read()  # planned over the folders of this generation
    assert log.compact() >= 1
    folded = sorted(log.current().collect())
    log.write(delivered(spark, [("u1", "again", 99)]), 1)  # its checkpoint was lost
    assert sorted(log.current().collect()) == folded and sorted(newest(before).collect()) == folded
    assert log.clean(3600) == 0 and log.clean(0) > 0 and sorted(log.current().collect()) == folded
    log.write(delivered(spark, [("u1", "new", 100)]), 3)
    assert {r.url: r.v for r in log.current().collect()}["u1"] == "new"


def test_a_lost_folding_changes_nothing(spark, tmp_path, monkeypatch):
    log = FoldedLog(spark, str(tmp_path / "log"), newest, fan=2)
    for b in range(4):
        log.write(delivered(spark, [(f"u{b % 2}", f"v{b}", b)]), b)
    whole, fold, calls = sorted(log.current().collect()), log.fold, []

    def lost(df):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost")
        return fold(df)

    monkeypatch.setattr(log, "fold", lost)
    with pytest.raises(RuntimeError):
        log.compact()
    assert sorted(newest(log.read()).collect()) == whole
    monkeypatch.setattr(log, "fold", fold)
    log.compact()
    assert sorted(log.current().collect()) == whole and log.clean(0) > 0 and sorted(log.current().collect()) == whole


def test_a_stream_that_is_folded_on_the_way_equals_the_batch(spark, tmp_path):
    files = [[(10 * f + i, "cnn", payload(f"u{(f + i) % 7}", f"t{f}"), T0 + timedelta(hours=(f * 5) % 11)) for i in range(3)] for f in range(9)]
    raw = _batches(spark, str(tmp_path / "raw"), files, SCHEMA)
    log = str(tmp_path / "log")
    jobs.publish_staging(raw, log, str(tmp_path / "cp"), fan=2)
    key = lambda df: sorted((r["url"], r["article_id"], r["title"]) for r in df.collect())
    assert key(jobs.current_staging(spark, log)) == key(staging.stage_articles(spark.read.parquet(str(tmp_path / "raw"))))
    assert any("/runs/" in p[2] for p in jobs.staging_log(spark, log).parts())


# -- the ledger ----------------------------------------------------------------------------------------
def test_ledger_equals_the_fact_after_every_batch(spark, tmp_path):
    """Late, moved, re-scored, unscored and withdrawn articles, each batch lost once half way and put in again."""
    rng = random.Random(3)
    sources = spark.createDataFrame([(i, f"s{i}", "u") for i in range(3)], "source_id int, source_name string, url string")
    dims = warehouse.dim_source(sources)
    book = FactLedger(spark, str(tmp_path / "ledger"), buckets=4)
    articles, scores = {}, {}
    for n in range(3):
        came = {rng.randrange(25): (rng.randrange(3), rng.choice([None, T0, T0 + timedelta(days=1), T0 + timedelta(days=2)]), rng.choice([None, 1, -4])) for _ in range(9)}
        rated = {rng.randrange(25): rng.choice([None, 0.5, -0.25, 0.1234]) for _ in range(6)}
        gone = {rng.randrange(25) for _ in range(2)} if n else set()
        batch = (spark.createDataFrame([(i, *x) for i, x in came.items()], "article_id long, source_id int, published_at timestamp_ntz, push_count long"),
                 spark.createDataFrame(list(rated.items()), "article_id long, score double"), spark.createDataFrame([(i,) for i in gone], "article_id long"))
        whole, calls = book.posts.upsert, []
        book.posts.upsert = lambda *a, **k: (calls.append(1), whole(*a, **k) if n % 2 else None, 1 / 0)  # lost before or after the posts were written
        with pytest.raises(ZeroDivisionError):
            book.apply(n, *batch)
        book.posts.upsert = whole
        book.apply(n, *batch)
        book.apply(n, *batch)
        articles = {i: x for i, x in (articles | came).items() if i not in gone}
        scores |= rated
        a = spark.createDataFrame([(i, *x) for i, x in articles.items()], "article_id long, source_id int, published_at timestamp_ntz, push_count long")
        s = spark.createDataFrame([(i, x) for i, x in scores.items() if x is not None], "article_id long, score double")
        got, want = (sorted(map(str, df.collect())) for df in (book.fact(sources, dims), warehouse.fact_sentiment(a, s, sources, dims)))
        assert got == want
    versions = book.totals.versions()
    book.apply(3, *batch)  # what is there already
    assert sorted(map(str, book.fact(sources, dims).collect())) == got and len(book.totals.versions()) == len(versions) + 1
    units = lambda version: {(r.bucket, r.folder) for r in book.totals.manifest(version).units}
    assert units(book.totals.version()) == units(versions[-1])


def test_changes_as_a_stream(spark, tmp_path):
    schema = "change string, article_id long, source_id int, published_at timestamp_ntz, push_count long, score double, at long"
    files = [[("article", 1, 4, T0, 5, None, 1), ("score", 2, None, None, None, 0.5, 1)],
             [("article", 2, 4, T0, None, None, 2), ("score", 1, None, None, None, 0.1, 2), ("score", 1, None, None, None, -0.5, 3)],
             [("article", 1, 4, T0 + timedelta(days=1), 5, None, 4), ("withdrawn", 2, None, None, None, None, 4)]]
    changes = _batches(spark, str(tmp_path / "changes"), files, schema)
    for _ in range(2):
        jobs.post_changes(changes, str(tmp_path / "ledger"), str(tmp_path / "cp"))
    sources = spark.createDataFrame([(4, "cnn", "u")], "source_id int, source_name string, url string")
    fact = FactLedger(spark, str(tmp_path / "ledger")).fact(sources, warehouse.dim_source(sources)).collect()
    assert [(str(r.fact_date), r.article_count, r.scored_articles, float(r.avg_sentiment), float(r.avg_push_count)) for r in fact] == [("2024-01-02", 1, 1, -0.5, 5.0)]
