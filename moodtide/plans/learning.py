"""Model training and scoring on Spark ML."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide import config
from moodtide.functions.numbers import numeric
from moodtide.functions.text import full_text
from moodtide.operators import evaluation, merge
from moodtide.plans import backtest, labeling
from moodtide.session import shared_dir

HASH_FEATURES = 1 << 16
Scorer = Callable[[DataFrame], DataFrame]  # adds a column ``probs``: negative, neutral, positive


def text_model() -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="words", pattern=r"[^\p{L}\p{N}_]+", minTokenLength=2),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=HASH_FEATURES),
        IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(labelCol="label_id", maxIter=20, regParam=0.01, family="multinomial"),
    ])


def train_text_model(labeled: DataFrame) -> PipelineModel | None:
    """Fit on the training part; None when fewer labels than the minimum exist."""
    if labeled.limit(config.MIN_LABELED).count() < config.MIN_LABELED:
        return None
    return text_model().fit(labeled)


def text_model_eval(labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Class report of the held-out test part."""
    parts = labeling.label_split(labeling.labeled_texts(labels, texts))
    model = train_text_model(parts.where("part = 'train'"))
    if model is None:
        return labels.sparkSession.createDataFrame([], "label string, precision double, recall double, f1 double, "
                                                       "support bigint, tp bigint")
    tested = model.transform(parts.where("part = 'test'"))
    names = F.array(*[F.lit(n) for n in config.LABELS])
    pairs = tested.select(F.col("label").alias("true"), F.get(names, F.col("prediction").cast("int")).alias("pred"))
    return evaluation.class_report(pairs, config.LABELS)


def model_scorer(model: PipelineModel) -> Scorer:
    return lambda df: model.transform(df).withColumn("probs", vector_to_array("probability"))


def score_from_probs(probs: Column) -> Column:
    """p(positive) - p(negative)."""
    return F.get(probs, F.lit(2)) - F.get(probs, F.lit(0))


def score_articles(articles: DataFrame, scores: DataFrame, scorer: Scorer, calculated_at: Column) -> DataFrame:
    """Scores for every article that has none, in one distributed pass over whole texts.

    Resumable: what was stored before a lost run is not scored again.
    """
    todo = labeling.unscored(articles, scores).select(
        "article_id", full_text(F.col("title"), F.col("content")).alias("text")).where("text IS NOT NULL")
    return scorer(todo).select("article_id", score_from_probs(F.col("probs")).alias("score"),
                               calculated_at.alias("calculated_at"))


def store_scores(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Upsert of scores; an article that had one keeps its first calculation time."""
    return merge.upsert(stored, new, ["article_id"], ["calculated_at"], keep=["calculated_at"])


# -- walk-forward prediction --------------------------------------------------------------------
def _forest() -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="next_day_up", featuresCol="x", numTrees=100, maxDepth=30, seed=42,
                                  featureSubsetStrategy="sqrt", minInstancesPerNode=1, cacheNodeIds=True)


def walk_forward_predict(feats: DataFrame, parallelism: int = 8) -> DataFrame:
    """Predictions of every test window by a forest trained on all days before it.

    ``feats`` is one row per market and day. It is written once to the shared folder, so that no fold computes it
    again; the list of folds (months of one calendar) is the only thing that comes to the driver. Folds do not depend
    on each other and are submitted side by side, like the folds of a cross-validation.
    """
    spark = feats.sparkSession
    path = shared_dir(spark, "features")
    days = VectorAssembler(inputCols=backtest.FEATURES, outputCol="x").transform(backtest.with_folds(feats))
    days.repartition("market").write.parquet(path)
    days = spark.read.parquet(path)
    folds = [(r["market"], r["fold"]) for r in days.where("fold > 0").select("market", "fold").distinct()
             .orderBy("market", "fold").toLocalIterator()]
    # Rows of a train set are days; a handful of partitions serve them best.
    out = shared_dir(spark, "predictions")

    def run(fold: tuple[str, int]) -> str | None:
        market, number = fold
        of_market = days.where((F.col("market") == market) & (F.col("fold") <= number)).coalesce(1)
        train = of_market.where(F.col("fold") < number)
        kinds = [r[0] for r in train.select("next_day_up").distinct().head(2)]
        if not kinds:
            return None
        test = of_market.where(F.col("fold") == number)
        if len(kinds) == 1:  # only one outcome ever seen: nothing to learn
            predicted = test.withColumn("prediction", F.lit(float(kinds[0])))
        else:
            predicted = _forest().fit(train).transform(test)
        target = f"{out}/market={market}/fold={number}"
        predicted.select("date", "close", "next_return", F.col("next_day_up").alias("true"),
                         F.col("prediction").cast("int").alias("pred")).write.parquet(target)
        return target

    with ThreadPool(parallelism) as pool:
        written = [t for t in pool.map(run, folds, chunksize=1) if t]
    schema = "date date, close double, next_return double, true int, pred int, market string, fold int"
    if not written:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out)


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """Final figures per market with the instrument's name."""
    names = {m: f"{symbol} {name}" for _, symbol, name in config.STOCKS
             for m, s in config.MARKET_INSTRUMENT.items() if s == symbol}
    return backtest.backtest_summary(backtest.backtest_curve(predictions)).withColumn(
        "display_name", config.lookup(F.col("market"), names))


def prediction_run(summary: DataFrame, run_at: Column) -> DataFrame:
    """History rows of a run, in the stored number formats; a return beyond its format still has its logarithm."""
    return summary.select(
        "market", run_at.alias("run_at"), numeric(F.col("accuracy"), 5, 4).alias("accuracy"),
        F.round("strategy_cumulative_return", 10).try_cast("decimal(38,4)").alias("strategy_cumulative_return"),
        F.log10("strategy_cumulative_return").alias("strategy_log10"),
        F.round("buy_and_hold_return", 10).try_cast("decimal(38,4)").alias("buy_and_hold_return"), "sample_days")
