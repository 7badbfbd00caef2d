"""Dedup, merges, checks and evaluation on small tables."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from moodtide.operators import dedup, evaluation, keywords, merge, monitoring, prices, quality
from moodtide.plans import backtest, labeling, staging, warehouse


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def raw(spark, items):
    return spark.createDataFrame(items, "raw_id long, source_name string, raw_payload string, ingested_at timestamp_ntz")


def test_latest_delivery_wins_and_first_id_stays(spark):
    at = datetime(2024, 1, 1)
    staged = staging.stage_articles(raw(spark, [
        (3, "cnn", '{"url":" u1 ","title":"a","author":"x","push_count":"5"}', at),
        (7, "cnn", '{"url":"u1","title":"b","author":" ","push_count":5.5}', at),
        (5, "cnn", '{"url":"u1","title":"late","content":""}', datetime(2023, 1, 1)),
        (9, "cnn", '{"url":"","title":"no address"}', at), (10, "cnn", "not json", at),
        (11, "cnyes", '{"url":"u2","push_count":-3,"published_at":"2024-01-02T03:04:05+08:00","scraped_at":"bad"}', at)]))
    got = {r["url"]: r for r in staged.collect()}
    assert set(got) == {"u1", "u2"}
    assert (got["u1"]["article_id"], got["u1"]["title"], got["u1"]["author_hash"], got["u1"]["push_count"]) == (3, "b", None, None)
    assert (got["u2"]["push_count"], got["u2"]["published_at"], got["u2"]["scraped_at"]) == (-3, datetime(2024, 1, 2, 3, 4, 5), at)


def test_odd_ids_keep_one_row_a_url(spark):
    """Null, negative, repeated and shared ids: each URL has one row, with its own fields."""
    at, later = datetime(2024, 1, 1), datetime(2024, 1, 2)
    item = lambda i, url, title, t=at: (i, "cnn", f'{{"url":"{url}","title":"{title}"}}', t)
    staged = staging.stage_articles(raw(spark, [
        item(None, "u0", "only"), item(1, "u1", "twice"), item(1, "u1", "twice"), item(4, "u2", "two"), item(4, "u3", "three"),
        item(-7, "u4", "below zero"), item(None, "u5", "old"), item(-9, "u5", "new"), item(8, "u6", "timed", later), item(9, "u6", "no time", None),
        item(-(2**63), "u7", "least"), item(2**63 - 1, "u7", "most")]))
    assert rows(staged.select("url", "article_id", "title")) == [
        ("u0", None, "only"), ("u1", 1, "twice"), ("u2", 4, "two"), ("u3", 4, "three"), ("u4", -7, "below zero"), ("u5", -9, "new"), ("u6", 8, "timed"),
        ("u7", -(2**63), "most")]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with most of the rows has to leave the map side as one row per partition."""
    df = spark.range(0, 20000, 1, 4).select(F.lit("hot").alias("url"), F.col("id").alias("raw_id"), F.lit(1).alias("x"))
    out = dedup.latest(df, ["url"], ["raw_id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
    assert rows(out) == [("hot", 19999, 1)]


def test_merge_policies_are_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, v string, at int")
    updates = spark.createDataFrame([(2, "B", 21), (2, "BB", 22), (3, "c", 30), (3, "C", 29)], "id int, v string, at int")
    inserted = merge.insert_absent(target, updates, ["id"], ["at"])
    assert rows(inserted) == [(1, "a", 10), (2, "b", 20), (3, "C", 29)]
    assert rows(merge.insert_absent(inserted, updates, ["id"], ["at"])) == rows(inserted)
    upserted = merge.upsert(target, updates, ["id"], ["at"])
    assert rows(upserted) == [(1, "a", 10), (2, "BB", 22), (3, "c", 30)]
    assert rows(merge.upsert(upserted, updates, ["id"], ["at"])) == rows(upserted)
    kept = merge.upsert(target, updates, ["id"], ["at"], keep=["at"])
    assert rows(kept) == [(1, "a", 10), (2, "BB", 20), (3, "c", 30)]
    fixes = spark.createDataFrame([(1, None, 11)], "id int, v string, at int")
    assert rows(merge.patch(target, fixes, ["id"], ["v", "at"])) == [(1, "a", 11), (2, "b", 20)]


def test_replace_partitions_leaves_other_days_alone(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, d string").write.partitionBy("d").parquet(path)
    new = spark.read.parquet(path).where("d = 'b'").withColumn("v", F.col("v") + 10)
    merge.replace_partitions(spark, new, path, ["d"])
    assert rows(spark.read.parquet(path).select("d", "v")) == [("a", 1), ("b", 12)]


def test_marts_use_rounded_facts_and_skip_empty_weights(spark):
    fact = spark.createDataFrame([
        (date(2024, 1, 1), "a", 3, 2, "0.3333", "1.50"), (date(2024, 1, 1), "a", 1, 1, "0.1000", None),
        (date(2024, 1, 1), "b", 4, 0, None, None)],
        "fact_date date, source_name string, article_count long, scored_articles long, s string, p string").select(
        "fact_date", "source_name", "article_count", "scored_articles", F.col("s").cast("decimal(6,4)").alias("avg_sentiment"),
        F.col("p").cast("decimal(8,2)").alias("avg_push_count"))
    got = [(r["source_name"], r["total_articles"], r["scored_articles"], r["avg_sentiment"], r["avg_push_count"])
           for r in warehouse.mart_daily_summary(fact).orderBy("source_name").collect()]
    # 4.5 / 4: the row without votes still counts in the denominator.
    assert [(n, t, s, a and float(a), p and float(p)) for n, t, s, a, p in got] == [("a", 4, 3, 0.2555, 1.13), ("b", 4, 0, None, None)]


def test_contract(spark):
    now = datetime(2024, 6, 1)
    good = ("t", "c", "https://x", 45, datetime(2024, 1, 1), [("a", "推", "m")])
    bad = [("  ", "c", "https://x", 1, now, None), ("t", "c", "https://x", 999, now, []), ("t", "c", "https://x", -100, now, []),
           ("t", "c", "https://x", None, datetime(2024, 6, 2), []), ("t", None, "ftp://x", None, None, []),
           ("t", "c", "https://x", 1, now, [("a", None, "m")])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate([good, *bad])], """i int, title string, content string, url string,
        push_count int, published_at timestamp_ntz, comments array<struct<author:string,push_tag:string,message:string>>""")
    got = [r["reasons"] for r in quality.validate_articles(df, F.lit(now)).orderBy("i").collect()]
    assert got == [[], ["title"], ["push_count"], [], ["published_at"], ["content", "url", "published_at"], ["comments"]]


def test_enforce_raises_on_first_failed_error(spark):
    df = spark.createDataFrame([(None,), (1,)], "x int")
    warn = quality.run_rules(df, [quality.not_null(1, "t", "x", quality.WARN)])
    quality.enforce(warn)
    with pytest.raises(quality.QualityError, match="t.x"):
        quality.enforce(warn.unionByName(quality.run_rules(df, [quality.not_null(2, "t", "x")])))


def test_mostly_and_empty_scope(spark):
    df = spark.range(200).select(F.when(F.col("id") > 0, F.lit(1)).otherwise(F.lit(500)).alias("x"))
    rules = [quality.satisfies(1, "range", "x", F.col("x").between(-100, 100), mostly=0.99),
             quality.satisfies(2, "range", "x", F.col("x").between(-100, 100)),
             quality.satisfies(3, "none", "x", F.col("x") > 0, where=F.col("x") < 0)]
    got = quality.run_rules(df, rules, skip_empty=True).orderBy("seq").collect()
    assert [(r["seq"], r["violations"], r["passed"]) for r in got] == [(1, 1, True), (2, 1, False)]


def test_price_changes_and_returns(spark):
    df = spark.createDataFrame([("v", date(2024, 1, 5), "10.00"), ("v", date(2024, 1, 8), "12.50"), ("v", date(2024, 1, 9), "11.00")],
                               "symbol string, trade_date date, c string").select("symbol", "trade_date", F.col("c").cast("decimal(10,2)").alias("close"))
    assert [r["change"] and float(r["change"]) for r in prices.with_changes(df).orderBy("trade_date").collect()] == [None, 2.5, -1.5]
    got = [(round(r["next_return"], 4), r["next_day_up"]) for r in prices.next_day_returns(df).orderBy("trade_date").collect()]
    assert got == [(0.25, 1), (-0.12, 0)]


def days(spark, n, start=date(2024, 1, 1), gap=None):
    base = spark.range(n).select(F.lit("TW").alias("market"), F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))
    return base if gap is None else base.where(gap)


def test_trailing_means_need_three_full_rows(spark):
    base = days(spark, 8).select("market", "date", F.when(F.dayofmonth("date") != 4, F.dayofmonth("date").cast("double")).alias("avg_sentiment"),
                                 F.lit(1).cast("long").alias("article_count"), F.lit(0.0).alias("avg_push_count"))
    returns = days(spark, 8).select(F.lit("0050").alias("symbol"), F.col("date").alias("trade_date"), F.lit(1.0).alias("close"),
                                    F.lit(0.1).alias("next_return"), F.lit(1).alias("next_day_up"))
    got = backtest.features(base, returns).orderBy("date").collect()
    # Day 4 has no score: the first complete row is day 8 (days 5, 6, 7 before it).
    assert [(r["date"].day, r["sentiment_3day_avg"], r["sentiment_yesterday"]) for r in got] == [(8, 6.0, 7.0)]


def test_folds_skip_empty_windows_and_keep_short_month_ends(spark):
    feats = days(spark, 400, date(2023, 11, 30), gap=~F.col("date").between(date(2024, 5, 1), date(2024, 9, 15)))
    got = [(r["fold"], r["train_end"], r["test_end"]) for r in backtest.walk_forward_folds(feats).orderBy("fold").collect()]
    assert got == [(0, date(2024, 2, 29), date(2024, 5, 29)), (2, date(2024, 8, 29), date(2024, 11, 29)),
                   (3, date(2024, 11, 29), date(2025, 2, 28))]
    # A last day on a fold's edge opens no further fold.
    edge = days(spark, 92, date(2024, 1, 1))
    assert backtest.walk_forward_folds(edge).count() == 0


def test_backtest_by_hand(spark):
    p = spark.createDataFrame([("TW", date(2024, 1, i), c, r, t, q) for i, c, r, t, q in [
        (1, 10.0, 0.1, 1, 1), (2, 11.0, -0.5, 0, 0), (3, 5.5, 1.0, 1, 1)]],
        "market string, date date, close double, next_return double, true int, pred int")
    s = backtest.backtest_summary(backtest.backtest_curve(p)).head()
    assert (s["accuracy"], round(s["strategy_cumulative_return"], 6), s["buy_and_hold_return"], s["sample_days"]) == (1.0, 2.2, 0.55, 3)


def test_class_report(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b")], "true string, pred string")
    got = {r["label"]: r for r in evaluation.class_report(pairs, ["a", "b", "c"]).collect()}
    assert (got["a"]["precision"], got["a"]["recall"]) == (1.0, 0.5)
    assert (round(got["b"]["precision"], 6), got["b"]["recall"], got["c"]["f1"]) == (0.666667, 1.0, 0.0)


def test_keywords_by_hand(spark):
    import math
    docs = spark.createDataFrame([(1, "Up up market"), (2, "market a")], "id int, t string")
    got = {r["Word"]: r["Score"] for r in keywords.top_keywords(docs, "id", "t").collect()}
    rare, common = math.log(3 / 2) + 1, 1.0
    norm = math.sqrt((2 * rare) ** 2 + 2 * rare ** 2 + common ** 2)
    assert got == {"market": round(common / norm + 1, 3), "up": round(2 * rare / norm, 3), "up up": round(rare / norm, 3),
                   "up market": round(rare / norm, 3)}


def test_keywords_of_several_blocks(spark, monkeypatch):
    """Rows of one id are one document, a null id counts for the numbers of documents only, a null text is a document without terms."""
    import math
    from collections import Counter
    monkeypatch.setattr(keywords, "BLOCK_CHARS", 10)
    rows_ = [(1, "aa bb aa"), (1, "bb cc"), (2, "bb dd x"), (3, None), (None, "aa ee"), (4, "Cc aa bb"), (5, ""), *[(10 + i, f"bb w{i % 4} cc") for i in range(12)]]
    tf = {}
    for i, t in rows_:
        w = [x.lower() for x in (t or "").split() if len(x) > 1]
        tf.setdefault(i, Counter()).update(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    df = Counter(x for c in tf.values() for x in c)
    want = Counter()
    for i, c in tf.items():
        weight = {x: k * (math.log((1 + len(rows_)) / (1 + df[x])) + 1) for x, k in c.items()}
        norm = math.sqrt(sum(v * v for v in weight.values()))
        if i is not None:
            want.update({x: v / norm for x, v in weight.items()})
    best = sorted(sorted(want.items(), reverse=True), key=lambda x: -round(x[1], 9))[:8]
    got = keywords.top_keywords(spark.createDataFrame(rows_, "id int, t string"), "id", "t", top=8).collect()
    assert [(r["Word"], r["Score"]) for r in got] == [(x, round(v, 3)) for x, v in best]
    assert keywords.top_keywords(spark.createDataFrame([], "id int, t string"), "id", "t").collect() == []


def test_keywords_write_by_different_terms(spark, monkeypatch, tmp_path):
    """What is written is a few bytes for each different term of a block, not for each term of each document."""
    import random
    monkeypatch.setattr(keywords, "shared_dir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    draw = random.Random(1)
    docs = spark.createDataFrame([(i, " ".join(draw.choices([f"w{j}" for j in range(60)], k=300))) for i in range(2000)], "id int, t string").repartition(4)
    assert keywords.top_keywords(docs, "id", "t").count() == 20
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < 1_000_000


def test_keywords_in_few_documents_are_not_left_out(spark, monkeypatch):
    """Frequent terms go first; when their scores do not prove that rarer ones are worse, these are added up as well."""
    monkeypatch.setattr(keywords, "FIRST_TERMS", 40)
    rows_ = [(i, " ".join(["same"] * (i % 3) + [f"w{(i * k) % 50}" for k in range(1, 9)])) for i in range(120)] + [(None, "same only here"), (500, "alone"), (501, None)]
    docs = spark.createDataFrame(rows_, "id int, t string")
    for top in (5, 5000):
        assert keywords.top_keywords(docs, "id", "t", top=top).collect() == keywords.top_keywords(docs, "id", "t", top=top, max_terms=10 ** 6).collect()


def test_latency_histogram(spark):
    log = spark.createDataFrame([(datetime(2024, 1, 1), "e", s) for s in [0.02] * 50 + [0.2] * 45 + [20.0] * 5],
                                "ts timestamp_ntz, endpoint string, seconds double")
    r = monitoring.latency_quantiles(log).head()
    assert (round(r["p50"], 6), round(r["p95"], 6), r["p99"]) == (0.025, 0.25, 10.0)


def test_label_split_is_exact_and_stratified(spark):
    labels = spark.range(205).select(F.col("id").alias("article_id"), F.when(F.col("id") < 105, "negative").otherwise("positive").alias("label"))
    got = {(r["label"], r["part"]): r["count"] for r in labeling.label_split(labels).groupBy("label", "part").count().collect()}
    assert got == {("negative", "test"): 11, ("negative", "val"): 11, ("negative", "train"): 83,
                   ("positive", "test"): 10, ("positive", "val"): 10, ("positive", "train"): 80}
