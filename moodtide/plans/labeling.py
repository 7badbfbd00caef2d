"""What to score and label next, labelled texts, and the train/validation/test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide import config
from moodtide.functions.text import full_text
from moodtide.operators.dedup import absent_from
from moodtide.operators.numbering import ranked

SEED = 42  # fixed value


def draw(article_id: Column, seed: int = SEED) -> Column:
    """Reproducible random key of a row; independent of partitioning."""
    return F.sha2(F.concat_ws(":", article_id.cast("string"), F.lit(str(seed))).cast("binary"), 256)


def unscored(articles: DataFrame, scores: DataFrame) -> DataFrame:
    """Every article without a score. Scoring takes all of them at once, in partitions."""
    return absent_from(articles, scores, ["article_id"])


def next_batch(open_articles: DataFrame, size: int) -> DataFrame:
    """The first ``size`` open articles by id, for a service that takes a few at a time."""
    return open_articles.orderBy("article_id").limit(size)


def label_candidates(articles: DataFrame, sources: DataFrame, labels: DataFrame, lang: str) -> DataFrame:
    """Articles of one language with a title and without a label."""
    names = sources.where(F.col("source_name").isin(config.crawled(lang=lang))).select("source_id", "source_name")
    return (articles.where(F.col("title") != "").join(names, "source_id")
            .join(labels.select("article_id"), "article_id", "left_anti"))


def label_sample(candidates: DataFrame, seed: int = SEED, size: int = 1) -> DataFrame:
    """Random pick: top rows by the random key, found partition by partition."""
    return candidates.orderBy(draw(F.col("article_id"), seed), "article_id").limit(size)


def labeled_texts(labels: DataFrame, articles: DataFrame) -> DataFrame:
    """Whole text and class number of every label, oldest label first when ordered by ``labeled_at``."""
    a = articles.select("article_id", full_text(F.col("title"), F.coalesce("content", F.lit(""))).alias("text"))
    number = config.lookup(F.col("label"), {n: str(i) for i, n in enumerate(config.LABELS)}).cast("int")
    return labels.join(a, "article_id").select("article_id", "text", "label", number.alias("label_id"), "labeled_at")


def label_split(labels: DataFrame, seed: int = SEED) -> DataFrame:
    """Stratified split: a tenth of every label for test, a tenth for validation, the rest for training."""
    places = ranked(labels, ["label"], draw(F.col("article_id"), seed), "_rank", "_of")
    tenth = F.ceil(F.col("_of") / 10)
    part = F.when(F.col("_rank") <= tenth, "test").when(F.col("_rank") <= 2 * tenth, "val").otherwise("train")
    return places.select(*labels.columns, part.alias("part"))
