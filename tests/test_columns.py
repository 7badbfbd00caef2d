"""Column rules on hand-made edge values."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from moodtide import config
from moodtide.functions import dates, pii, text, urls
from moodtide.functions.register import register_functions


def apply(spark, values, rule, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.select("i", rule(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_push_decode(spark):
    given = ["爆", "XX", "X3", "X", "12", "", "abc", None, " 7 ", "-5", "X10"]
    assert apply(spark, given, text.push_decode) == [100, -100, -30, None, 12, None, None, None, 7, -5, -100]


def test_push_clamp(spark):
    assert apply(spark, [None, 5, 500, -500], text.push_clamp, "int") == [0, 5, 100, -100]


def test_epoch(spark):
    got = apply(spark, [1700000000.0, 1700000000000.0, 1700000000.5], lambda c: dates.epoch_to_ts(c).cast("timestamp_ntz"), "double")
    at = datetime(2023, 11, 14, 22, 13, 20)
    assert got == [at, at, at.replace(microsecond=500000)]


@pytest.mark.parametrize("source, written, expected", [
    ("ptt", "2024-02-05 08:00:00", datetime(2024, 2, 5)),
    ("wsj", "Mon, 05 Feb 2024 10:11:12 GMT", datetime(2024, 2, 5, 10, 11, 12)),
    ("cnn", "Mon, 5 Feb 2024 10:11:12 +0800", datetime(2024, 2, 5, 10, 11, 12)),
    ("reddit", "1700000000", datetime(2023, 11, 14, 22, 13, 20)),
    ("reddit", "1700000000.25", datetime(2023, 11, 14, 22, 13, 20, 250000)),
    ("cnyes", "2024-02-05T08:00:00+08:00", datetime(2024, 2, 5, 8)),
    ("ptt", "Mon, 05 Feb 2024 10:11:12 GMT", None),
    ("wsj", "2024-02-05T08:00:00Z", datetime(2024, 2, 5, 8)),
    ("wsj", "2024-02-05", datetime(2024, 2, 5)),
    ("cnyes", "", None), ("cnyes", "   ", None), ("cnyes", None, None),
    ("cnyes", "2024-13-05", None), ("cnyes", "2024-02-30 10:00:00", None), ("reddit", "soon", None),
    ("elsewhere", "2024-02-05 01:02:03.999", datetime(2024, 2, 5, 1, 2, 3)),
])
def test_parse_date_by_source(spark, source, written, expected):
    df = spark.createDataFrame([(written, source)], "t string, s string")
    rule = dates.parse_date_by_source(F.col("t"), F.col("s")).cast("timestamp_ntz")
    assert df.select(rule).head()[0] == expected


@pytest.mark.parametrize("written, strict, full", [
    ("2024-02-05T10:11:12.5Z", datetime(2024, 2, 5, 10, 11, 12, 500000), datetime(2024, 2, 5, 10, 11, 12, 500000)),
    ("2024-02-05T10:11:12Z", datetime(2024, 2, 5, 10, 11, 12), datetime(2024, 2, 5, 10, 11, 12)),
    ("2024-02-05T10:11:12+0800", datetime(2024, 2, 5, 10, 11, 12), datetime(2024, 2, 5, 10, 11, 12)),
    ("2024-02-05T10:11:12.123456-05:00", datetime(2024, 2, 5, 10, 11, 12, 123456), datetime(2024, 2, 5, 10, 11, 12, 123456)),
    ("2024-02-05T10:11:12", None, datetime(2024, 2, 5, 10, 11, 12)),
    ("2024-02-05 10:11:12", None, datetime(2024, 2, 5, 10, 11, 12)),
    ("2024-02-05", None, datetime(2024, 2, 5)),
    ("2024-02-30T10:11:12Z", None, None), ("05 Feb 2024", None, None), ("", None, None), (None, None, None),
])
def test_parse_iso(spark, written, strict, full):
    df = spark.createDataFrame([(written,)], "t string")
    feed = dates.parse_iso(F.col("t"), plain_clock=False, date_only=False).cast("timestamp_ntz")
    archive = dates.parse_iso(F.col("t")).cast("timestamp_ntz")
    assert tuple(df.select(feed, archive).head()) == (strict, full)


def test_dates_from_addresses(spark):
    got = apply(spark, ["https://x/2024/02/30/a", "https://x/2024/02/29/a", "https://x/2024/2/9/a"],
                lambda c: dates.date_from_url(c).cast("timestamp_ntz"))
    assert got == [None, datetime(2024, 2, 29), None]
    got = apply(spark, ["20240102030405", "20240102", "20249902", "2024010299", "2024"],
                lambda c: dates.snapshot_stamp(c).cast("timestamp_ntz"))
    assert got == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2), None, datetime(2024, 1, 2), None]


def test_offsets_are_reported(spark):
    assert apply(spark, ["2024-02-05T08:00:00+08:00", "2024-02-05T08:00:00Z", "2024-02-05T08:00:00+00:00"], dates.has_offset) == [
        True, False, False]


def test_pii(spark):
    once = apply(spark, ["bob", "bob", None], pii.pii_hash)
    assert once[0] == once[1] and len(once[0]) == 16 and once[2] is None
    assert apply(spark, ["bob", once[0], "", None], pii.mask_author) == [once[0], once[0], None, None]


def test_placeholder_salt_is_refused_in_production(monkeypatch):
    monkeypatch.setenv("ENV", "production")
    monkeypatch.delenv("PII_HASH_SALT", raising=False)
    with pytest.raises(RuntimeError):
        config.pii_salt()


def test_guarded_casts(spark):
    given = ["5", "-5", "5.0", "1e3", "99999999999", None, "+5"]
    assert apply(spark, given, text.guarded_int) == [5, -5, None, None, None, None, None]
    assert apply(spark, given, text.guarded_float) == [5.0, -5.0, 5.0, None, 99999999999.0, None, None]


@pytest.mark.parametrize("given, expected", [
    ("HTTP://WWW.X.com:443/a/?utm_source=f&b=1&c=#t", "https://www.x.com/a?b=1&c="),
    ("not a url", "not a url"), ("mailto:a@b.c", "mailto:a@b.c"), ("http://x.com", "https://x.com/"),
    ("http://x.com:80/", "https://x.com/"), ("http://x.com:8080/a//", "https://x.com:8080/a"),
    ("https://x.com/a?UTM_ID=1&Ref=2", "https://x.com/a"), ("https://x.com/a?q=a+b&r=%C3%A9&s", "https://x.com/a?q=a+b&r=%C3%A9&s="),
    ("https://x.com/a?p=50%&t=~*", "https://x.com/a?p=50%25&t=~%2A"), ("https://x.com/a;v=1?b=2", "https://x.com/a;v=1?b=2"),
    ("https://x.com/a/;v=1", "https://x.com/a;v=1"), ("https://x.com/a;", "https://x.com/a"), ("https://x.com?a=http://y/", "https://x.com/?a=http%3A%2F%2Fy%2F"),
    ("https://x.com//", "https://x.com"), ("https://x.com/a?&&", "https://x.com/a"),
    ("https://X.com/Ab?b=2&a=1", "https://x.com/Ab?b=2&a=1"), (None, None), ("", ""),
])
def test_canonical_url(spark, given, expected):
    assert apply(spark, [given], urls.canonical_url) == [expected]


def test_lines_and_titles(spark):
    body = "\n  own words \n: quoted\n※ 引述《x》\nhttp://a.example\n\n  : kept \n"
    assert apply(spark, [body], text.clean_body_lines) == ["own words\n: kept"]
    assert apply(spark, ["A - CNN", "B | WSJ", "C | WSJ | CNN", "C | CNN | WSJ"], text.strip_title_suffix) == [
        "A", "B", "C", "C | CNN"]
    assert apply(spark, ["[公告] x", "y", None], lambda c: text.has_skip_keyword(c)) == [True, False, None]
    assert apply(spark, ["https://x/a/b/", "x"], text.last_path_segment) == ["b", "x"]


def test_sql_functions_agree_with_columns(spark):
    register_functions(spark)
    given = ["HTTP://WWW.X.com:443/a/?utm_source=f&b=1&c=#t", "not a url", "http://x.com", "http://x.com:8080/a//", "https://x.com/a?q=a+b&r=%C3%A9&s",
             "https://x.com/a/;v=1?b=50%&t=~*", "https://x.com/a;", None]
    assert apply(spark, given, lambda c: F.call_function("canonical_url", c)) == apply(spark, given, urls.canonical_url)
    df = spark.createDataFrame([("爆", "2024-02-05 08:00:00", "ptt"), ("X 3", "1700000000.5", "reddit"), ("x", "2024-02-05", "cnn"),
                                ("\t12\n", "Mon, 5 Feb 2024 08:00:00 GMT", "wsj"), ("\u3000X3\u3000", "2024-02-05T08:00:00+08:00", "cnyes"), ("XX", "\t", "ptt"),
                                ("X", " 2024-02-05", "reddit"), ("XXX", "1e9", "reddit"), (" +5 ", "2024-13-05", "cnn"), ("\u00a0爆", "99999999999999999999", "reddit"),
                                ("99999999999999999999", "", "cnn"), ("", None, None), (None, "x", "x")],
                               "badge string, t string, source string")
    both = df.select(
        F.expr("push_decode(badge)"), text.push_decode(F.col("badge")), F.expr("parse_date_by_source(t, source)"),
        dates.parse_date_by_source(F.col("t"), F.col("source")), F.expr("pii_hash(t)"), pii.pii_hash(F.col("t")),
        F.expr("market_for_source(source)"), config.market_for_source(F.col("source"))).collect()
    for row in both:
        assert row[0::2] == row[1::2]
