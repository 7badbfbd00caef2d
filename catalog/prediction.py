"""Features, walk-forward folds, back-test, labels and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import day, dec, fx, query, ts
from moodtide import config
from moodtide.operators import evaluation, prices
from moodtide.plans import backtest, labeling, learning
from moodtide.sources.domain import Desk

c = F.col


def base(desk: Desk):
    return backtest.daily_base(desk.articles_long())


def returns(desk: Desk):
    return prices.next_day_returns(desk.prices())


def features(desk: Desk):
    return backtest.features(base(desk), returns(desk))


@query("daily_features_base", f"""
 SELECT market, {day("date")} AS date, {fx("avg_sentiment")} AS avg_sentiment, article_count, {fx("avg_push_count")} AS avg_push_count
 FROM v_daily_base""")
def daily_features_base(desk: Desk):
    return base(desk)


_NUMBERS = ["close", "next_return", "avg_sentiment", "avg_push_count", "sentiment_yesterday", "sentiment_3day_avg",
            "push_count_3day_avg", "article_count_3day_avg"]


@query("features", f"""
 SELECT market, {day("date")} AS date, CAST(next_day_up AS BIGINT) AS next_day_up, article_count,
  {", ".join(f"{fx(n)} AS {n}" for n in _NUMBERS)} FROM v_features""")
def features_query(desk: Desk):
    return features(desk)


@query("prediction_gate", """
 SELECT m.market, s.n AS sentiment_days, s.k AS scored_days, p.n AS price_days, f.n AS feature_days,
  CASE WHEN f.n < 60 THEN 'too_few_days' ELSE 'ready' END AS state
 FROM (VALUES ('TW', '0050'), ('US', 'VOO')) m(market, symbol)
 JOIN (SELECT market, count(*) AS n, count(avg_sentiment) AS k FROM v_daily_base GROUP BY 1) s ON s.market = m.market
 JOIN (SELECT symbol, count(*) AS n FROM v_returns GROUP BY 1) p ON p.symbol = m.symbol
 JOIN (SELECT market, count(*) AS n FROM v_features GROUP BY 1) f ON f.market = m.market""")
def prediction_gate(desk: Desk):
    return backtest.prediction_gate(base(desk), returns(desk), features(desk))


@query("walk_forward_folds", f"""
 SELECT f.market, CAST(f.fold AS BIGINT) AS fold, {day("f.train_end")} AS train_end, {day("f.test_end")} AS test_end,
  count(*) FILTER (WHERE x.date >= f.train_end) AS test_days, count(*) FILTER (WHERE x.date < f.train_end) AS train_days
 FROM v_folds f JOIN v_features x ON x.market = f.market AND x.date < f.test_end
 GROUP BY ALL HAVING count(*) FILTER (WHERE x.date >= f.train_end) > 0 AND count(*) FILTER (WHERE x.date < f.train_end) > 0""")
def walk_forward_folds(desk: Desk):
    return backtest.walk_forward_folds(features(desk))


def rule_predictions(desk: Desk):
    """A fixed rule in place of a model, so that the back-test figures can be checked: up when the mood rises."""
    up = F.round("avg_sentiment", 9) >= F.round("sentiment_3day_avg", 9)
    return backtest.with_folds(features(desk)).where("fold > 0").select(
        "market", "date", "close", "next_return", c("next_day_up").alias("true"), up.cast("int").alias("pred"))


def curve(desk: Desk):
    return backtest.backtest_curve(rule_predictions(desk))


@query("backtest_curve", f"""
 SELECT market, {day("date")} AS date, CAST(true_up AS BIGINT) AS "true", CAST(pred AS BIGINT) AS pred,
  {fx("log10(strategy_cumulative_return)")} AS strategy_log10, {fx("buy_and_hold_return")} AS buy_and_hold_return FROM v_curve""")
def backtest_curve(desk: Desk):
    """The product over years of days is shown as its logarithm."""
    return curve(desk).select("market", "date", "true", "pred", F.log10("strategy_cumulative_return").alias("strategy_log10"),
                              "buy_and_hold_return")


@query("rebased_curve", f"""
 SELECT market, {day("date")} AS date,
  {fx("log10(strategy_cumulative_return / first_value(strategy_cumulative_return) OVER w)")} AS strategy_log10,
  {fx("buy_and_hold_return / first_value(buy_and_hold_return) OVER w")} AS buy_and_hold_return
 FROM v_curve WHERE date BETWEEN DATE '1998-01-01' AND DATE '1999-06-30' WINDOW w AS (PARTITION BY market ORDER BY date)""")
def rebased_curve(desk: Desk):
    from moodtide.plans.serving import rebased_curve as rebased
    return rebased(curve(desk), "1998-01-01", "1999-06-30").select(
        "market", "date", F.log10("strategy_cumulative_return").alias("strategy_log10"), "buy_and_hold_return")


@query("backtest_summary", f"""
 SELECT market, {fx("avg(CASE WHEN true_up = pred THEN 1.0 ELSE 0.0 END)")} AS accuracy,
  {fx("log10(arg_max(strategy_cumulative_return, date))")} AS strategy_log10,
  {fx("arg_max(buy_and_hold_return, date)")} AS buy_and_hold_return, count(*) AS sample_days,
  CASE WHEN arg_max(strategy_cumulative_return, date) > arg_max(buy_and_hold_return, date) THEN 'above' ELSE 'below' END AS against_hold
 FROM v_curve GROUP BY 1""")
def backtest_summary(desk: Desk):
    s = backtest.backtest_summary(curve(desk))
    return s.select("market", "accuracy", F.log10("strategy_cumulative_return").alias("strategy_log10"), "buy_and_hold_return",
                    "sample_days", F.when(c("excess_return") > 0, "above").otherwise("below").alias("against_hold"))


_CELLS = """(SELECT CAST(true_up AS VARCHAR) AS t, CAST(pred AS VARCHAR) AS p FROM v_predictions)"""


def pairs(desk: Desk):
    return rule_predictions(desk).select(c("true").cast("string").alias("true"), c("pred").cast("string").alias("pred"))


@query("confusion_matrix", f"""
 SELECT g.t AS "true", g.p AS pred, count(x.t) AS n
 FROM (SELECT * FROM (VALUES ('0'), ('1')) a(t), (VALUES ('0'), ('1')) b(p)) g LEFT JOIN {_CELLS} x ON x.t = g.t AND x.p = g.p GROUP BY 1, 2""")
def confusion_matrix(desk: Desk):
    return evaluation.confusion_matrix(pairs(desk), ["0", "1"])


_REPORT = f"""(SELECT l.label, count(*) FILTER (WHERE t = label AND p = label) AS tp, count(*) FILTER (WHERE t = label) AS support,
   count(*) FILTER (WHERE p = label) AS predicted FROM (VALUES ('0'), ('1')) l(label), {_CELLS} GROUP BY 1)"""


@query("class_report", f"""
 SELECT label, {fx("coalesce(tp / nullif(predicted, 0), 0)")} AS precision, {fx("coalesce(tp / nullif(support, 0), 0)")} AS recall,
  {fx("coalesce(2.0 * tp / nullif(predicted + support, 0), 0)")} AS f1, support, tp FROM {_REPORT}""")
def class_report(desk: Desk):
    return evaluation.class_report(pairs(desk), ["0", "1"])


@query("class_overall", f"""
 SELECT {fx("sum(tp) / sum(support)")} AS accuracy, {fx("avg(2.0 * tp / (predicted + support))")} AS macro_f1,
  CAST(sum(support) AS BIGINT) AS samples FROM {_REPORT}""")
def class_overall(desk: Desk):
    return evaluation.overall(evaluation.class_report(pairs(desk), ["0", "1"]))


# -- labels -----------------------------------------------------------------------------------------
@query("unscored_articles", "SELECT article_id, title || ' ' || content AS text FROM v_articles WHERE value < 5")
def unscored_articles(desk: Desk):
    todo = labeling.unscored(desk.articles(), desk.scores())
    return todo.select("article_id", F.concat_ws(" ", "title", "content").alias("text"))


@query("unscored_batch", "SELECT article_id, title FROM v_articles WHERE value < 5 ORDER BY article_id LIMIT 500")
def unscored_batch(desk: Desk):
    return labeling.next_batch(labeling.unscored(desk.articles(), desk.scores()), 500).select("article_id", "title")


_CANDIDATES = """(SELECT article_id, title, source_name FROM v_articles
  WHERE source_name IN ('ptt', 'cnyes') AND title <> '' AND article_id NOT IN (SELECT article_id FROM v_labels))"""


def candidates(desk: Desk):
    return labeling.label_candidates(desk.articles(), desk.sources(), desk.article_labels(), "zh")


@query("label_candidates", f"SELECT * FROM {_CANDIDATES}")
def label_candidates(desk: Desk):
    return candidates(desk).select("article_id", "title", "source_name")


@query("label_sample", f"""
 SELECT * FROM {_CANDIDATES} ORDER BY sha256(article_id || ':42'), article_id LIMIT 10""")
def label_sample(desk: Desk):
    return labeling.label_sample(candidates(desk), size=10).select("article_id", "title", "source_name")


@query("labeled_texts", f"""
 SELECT l.article_id, t.title || ' ' || t.content AS text, l.label,
  CAST(CASE l.label WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END AS BIGINT) AS label_id, {ts("l.labeled_at")} AS labeled_at
 FROM v_labels l JOIN v_texts t ON t.article_id = l.article_id""")
def labeled_texts(desk: Desk):
    return labeling.labeled_texts(desk.article_labels(), desk.texts())


@query("label_split", """
 SELECT article_id, label, CASE WHEN r <= ceil(n / 10) THEN 'test' WHEN r <= 2 * ceil(n / 10) THEN 'val' ELSE 'train' END AS part
 FROM (SELECT article_id, label, count(*) OVER (PARTITION BY label) AS n,
   row_number() OVER (PARTITION BY label ORDER BY sha256(article_id || ':42'), article_id) AS r FROM v_labels)""")
def label_split(desk: Desk):
    return labeling.label_split(desk.article_labels()).select("article_id", "label", "part")


@query("label_progress", f"""
 SELECT l.label, count(x.label) AS labeled, {fx("least(1.0, (SELECT count(*) FROM v_labels) / 500.0)")} AS progress
 FROM (VALUES ('negative'), ('neutral'), ('positive')) l(label) LEFT JOIN v_labels x ON x.label = l.label GROUP BY 1""")
def label_progress(desk: Desk):
    return evaluation.label_progress(desk.article_labels(), config.LABELS, config.LABEL_TARGET)


# -- models: values depend on the fitted model, so the check is on the rows ---------------------------
def _scorer(desk: Desk):
    labeled = labeling.labeled_texts(desk.article_labels(), desk.texts())
    model = learning.train_text_model(labeled)
    if model is None:
        raise ValueError("too few labels to train a scorer")
    return learning.model_scorer(model)


@query("score_articles")
def score_articles(desk: Desk):
    """Scores for every text without a label-derived one."""
    known = desk.article_labels().select("article_id")
    return learning.score_articles(desk.texts(), known, _scorer(desk), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@query("score_articles_fixed", f"""
 SELECT article_id, {fx("(n % 7) / 14.0 - (n % 100) / 200.0")} AS score, '2024-02-01 00:00:00.000000' AS calculated_at
 FROM (SELECT article_id, length(title || ' ' || content) AS n FROM v_texts) WHERE article_id NOT IN (SELECT article_id FROM v_labels)""")
def score_articles_fixed(desk: Desk):
    """The scoring pass with probabilities that follow from the length of the whole text, so that its values have SQL."""
    n = F.length("text")
    scorer = lambda df: df.withColumn("probs", F.array((n % 100) / 200.0, F.lit(0.0), (n % 7) / 14.0))
    return learning.score_articles(desk.texts(), desk.article_labels().select("article_id"), scorer, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@query("text_model_eval")
def text_model_eval(desk: Desk):
    return learning.text_model_eval(desk.article_labels(), desk.texts())


@query("walk_forward_predict")
def walk_forward_predict(desk: Desk):
    return learning.walk_forward_predict(features(desk))


@query("prediction_summary", f"""
 SELECT market, CASE market WHEN 'TW' THEN '0050 元大台灣50' ELSE 'VOO Vanguard S&P 500 ETF' END AS display_name,
  {fx("avg(CASE WHEN true_up = pred THEN 1.0 ELSE 0.0 END)")} AS accuracy,
  {fx("log10(arg_max(strategy_cumulative_return, date))")} AS strategy_log10,
  {fx("arg_max(buy_and_hold_return, date)")} AS buy_and_hold_return, count(*) AS sample_days FROM v_curve GROUP BY 1, 2""")
def prediction_summary(desk: Desk):
    """What the service shows for stored predictions."""
    s = learning.prediction_summary(rule_predictions(desk))
    return s.select("market", "display_name", "accuracy", F.log10("strategy_cumulative_return").alias("strategy_log10"),
                    "buy_and_hold_return", "sample_days")


@query("prediction_runs", f"""
 SELECT market, '2024-02-01 00:00:00.000000' AS run_at,
  CAST({dec("avg(CASE WHEN true_up = pred THEN 1.0 ELSE 0.0 END)", 5, 4)} AS DOUBLE) AS accuracy,
  {fx("log10(arg_max(strategy_cumulative_return, date))")} AS strategy_log10,
  {fx("arg_max(buy_and_hold_return, date)", 4)} AS buy_and_hold_return, count(*) AS sample_days FROM v_curve GROUP BY 1""")
def prediction_runs(desk: Desk):
    """One history row per market, appended to a table."""
    from moodtide.session import shared_dir
    path = shared_dir(desk.spark, "runs")
    summary = backtest.backtest_summary(curve(desk))
    learning.prediction_run(summary, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")).write.mode("append").parquet(path)
    return desk.spark.read.parquet(path).drop("strategy_cumulative_return")  # beyond the digits of a float; its logarithm is compared
