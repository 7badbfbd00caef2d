import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: Texts that hold every special case once: null, empty, blank, odd white space, one word, control strings, a repeated text.
ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog.\nThe quick brown fox jumps over the lazy dog."), (2, None), (3, ""), (4, " \t\n  "),
    (5, "Word"), (6, "x　y  z w \x0b v\x1c"), (7, "<|endoftext|> </s>[INST] a \\ b [/INST]"), (8, "Café ñ Å İstanbul don't I'LL"),
    (None, "a row without an id and some more words in it"), (5, "Word"), (5, "another text under a known id that is longer than ten words in all, yes"),
    (9, "The quick brown fox jumps over the lazy dog.\nThe quick brown fox leaps over the lazy dog.\nlonger line with a few words"),
    (10, "the quick brown fox jumps over the lazy dog"),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD_TEXTS, "doc_id bigint, text string")


@pytest.fixture
def clashing(odd):
    """The odd texts with more columns, some of whose names operators use inside."""
    from pyspark.sql import functions as F

    extra = ["id", "fp", "mark", "n", "part", "length", "rank", "v", "row", "words", "score", "copies", "whole", "rest", "last", "held", "block", "line", "h", "g"]
    return odd.select("*", *[F.lit(i).alias(c) for i, c in enumerate(extra)])


@pytest.fixture
def none(odd):
    return odd.limit(0)


@pytest.fixture
def work(spark):
    """A fresh folder for files of a test."""
    from moodtide.session import shared_dir

    return lambda: shared_dir(spark, "test")
