"""The column rules as SQL functions of a session.

They are SQL expressions, not Python functions: Catalyst inlines them like any other expression.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from moodtide.config import ALL_SOURCES, pii_salt
from moodtide.functions import dates, text, urls
from moodtide.functions.pii import HASH_CHARS


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _canonical_url_sql() -> str:
    head = "substring_index(substring_index(url, '#', 1), '?', 1)"
    rest = f"substring({head}, instr({head}, '://') + 3)"
    path = f"substring({rest}, length(substring_index({rest}, '/', 1)) + 1)"
    query = f"substring(substring_index(url, '#', 1), length({head}) + 2)"
    cut = lambda p: f"CASE WHEN {p} IN ('', '/') THEN '/' ELSE rtrim('/', {p}) END"
    params = f"regexp_extract({path}, '(?s)^(?:.*/)?[^/;]*(;.*)$', 1)"
    before = f"substring({path}, 1, length({path}) - length({params}))"
    decode = lambda x: f"try_url_decode(regexp_replace({x}, '%(?![0-9A-Fa-f]{{2}})', '%25'))"
    encode = lambda x: f"replace(replace(url_encode({decode(x)}), '*', '%2A'), '%7E', '~')"
    name, value = "substring_index(p, '=', 1)", "substring(p, length(substring_index(p, '=', 1)) + 2)"
    pairs = (f"transform(filter(split({query}, '&'), p -> p <> '' AND lower({decode(name)}) NOT IN ({_quoted(urls.TRACKING_PARAMS)})), "
             f"p -> concat('&', {encode(name)}, '=', {encode(value)}))")
    return rf"""CASE WHEN url RLIKE '{urls._ABSOLUTE}' THEN concat('https://',
        regexp_replace(lower(substring_index({rest}, '/', 1)), ':(443|80)$', ''),
        CASE WHEN contains({path}, ';') THEN concat({cut(before)}, CASE WHEN {params} = ';' THEN '' ELSE {params} END) ELSE {cut(path)} END,
        CASE WHEN {query} = '' THEN '' ELSE regexp_replace(array_join({pairs}, ''), '^&', '?') END) ELSE url END"""


def register_functions(spark: SparkSession) -> list[str]:
    markets = " ".join(f"WHEN '{n}' THEN '{s['market']}'" for n, s in ALL_SOURCES.items())
    day, clock = r"[0-9]{4}-[0-9]{2}-[0-9]{2}", r"[0-9]{2}:[0-9]{2}:[0-9]{2}"
    mail = rf"^[A-Za-z]{{3}},\\s+([0-9]{{1,2}}\\s+[A-Za-z]{{3}}\\s+[0-9]{{4}}\\s+{clock})"
    blank = text._BLANK
    strip = lambda x: f"regexp_replace({x}, r'^{blank}+|{blank}+$', '')"
    number = lambda x: f"CASE WHEN {strip(x)} RLIKE '^[+-]?[0-9]+$' THEN try_cast({strip(x)} AS BIGINT) END"
    badge = strip("badge")
    definitions = {
        "pii_hash(author STRING) RETURNS STRING":
            f"substring(sha2(CAST(concat('{pii_salt()}:', author) AS BINARY), 256), 1, {HASH_CHARS})",
        "market_for_source(name STRING) RETURNS STRING": f"CASE name {markets} END",
        "push_decode(badge STRING) RETURNS BIGINT": f"""
            CASE WHEN {badge} = '{text.PUSH_BURST}' THEN {text.PUSH_LIMIT}
                 WHEN {badge} = '{text.PUSH_BURIED}' THEN -{text.PUSH_LIMIT}
                 WHEN startswith({badge}, 'X') THEN -10 * ({number(f"substring({badge}, 2)")})
                 ELSE {number(badge)} END""",
        "parse_date_by_source(t STRING, source STRING) RETURNS TIMESTAMP": rf"""
            CASE WHEN t IS NULL OR trim(t) = '' THEN NULL
                 WHEN source = '{dates.LOCAL_TIME_SOURCE}' AND t RLIKE '^{day}[T ]{clock}'
                   THEN to_utc_timestamp(try_to_timestamp(translate(substring(t, 1, 19), 'T', ' '),
                                                          'yyyy-MM-dd HH:mm:ss'), '{dates.LOCAL_ZONE}')
                 WHEN source = '{dates.EPOCH_SOURCE}' AND t RLIKE '^[0-9]+(\\.[0-9]+)?$'
                   THEN timestamp_micros(try_cast(rint(try_cast(t AS DOUBLE) * 1e6) AS BIGINT))
                 WHEN source IN ({_quoted(dates.MAIL_DATE_SOURCES)}) AND t RLIKE '{mail}'
                   THEN try_to_timestamp(regexp_replace(regexp_extract(t, '{mail}', 1), '\\s+', ' '),
                                         'd MMM yyyy HH:mm:ss')
                 WHEN t RLIKE '^{day}[T ]{clock}'
                   THEN try_to_timestamp(translate(substring(t, 1, 19), 'T', ' '), 'yyyy-MM-dd HH:mm:ss')
                 WHEN t RLIKE '^{day}' THEN try_to_timestamp(substring(t, 1, 10), 'yyyy-MM-dd') END""",
        "canonical_url(url STRING) RETURNS STRING": _canonical_url_sql(),
    }
    for signature, body in definitions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [s.split("(")[0] for s in definitions]
