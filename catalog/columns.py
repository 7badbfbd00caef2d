"""Column rules, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, ts
from catalog.views import parse_date
from moodtide import config
from moodtide.functions import dates, pii, text, urls
from moodtide.sources.domain import Desk, epoch_seconds

c = F.col

# Vote badges as list pages show them.
_BADGE = """CASE WHEN value >= 150 THEN '爆' WHEN value >= 120 THEN 'XX'
  WHEN value >= 110 THEN concat('X', CAST(CAST(floor(value - 110) AS INT) AS STRING)) WHEN value >= 105 THEN 'X'
  WHEN value >= 100 THEN event_type WHEN value < 1 THEN ''
  ELSE concat(' ', CAST(CAST(floor(value) AS INT) AS STRING), ' ') END"""


@query("push_decode", f"""
 SELECT event_id, CAST(CASE WHEN t = '爆' THEN 100 WHEN t = 'XX' THEN -100
   WHEN regexp_matches(t, '^X[0-9]+$') THEN CAST(substr(t, 2) AS BIGINT) * -10
   WHEN regexp_matches(t, '^[0-9]+$') THEN CAST(t AS BIGINT) END AS BIGINT) AS push_count
 FROM (SELECT event_id, trim({_BADGE.replace('STRING', 'VARCHAR')}) AS t FROM events)""")
def push_decode(desk: Desk):
    return desk.table("events").select("event_id", text.push_decode(F.expr(_BADGE)).alias("push_count"))


@query("push_clamp", """
 SELECT event_id, CAST(least(greatest(coalesce(CASE WHEN event_type <> 'error' THEN CAST(floor(value * 2) AS BIGINT) - 150 END,
   0), -100), 100) AS BIGINT) AS push_count FROM events""")
def push_clamp(desk: Desk):
    votes = F.when(c("event_type") != "error", F.floor(c("value") * 2) - 150)
    return desk.table("events").select("event_id", text.push_clamp(votes).alias("push_count"))


@query("epoch_to_ts", f"""
 SELECT event_id, {ts("make_timestamp(CAST(CASE WHEN s > 1e12 THEN round_even(s * 1e3, 0) ELSE round_even(s * 1e6, 0) END AS BIGINT))")}
   AS published_at
 FROM (SELECT event_id, CAST(CASE WHEN value >= 50 THEN epoch_us(ts) // 1000 ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS DOUBLE) AS s
       FROM events)""")
def epoch_to_ts(desk: Desk):
    at = c("ts").cast("timestamp")
    seconds = F.when(c("value") >= 50, F.unix_millis(at)).otherwise(F.unix_seconds(at))
    return desk.table("events").select("event_id", dates.epoch_to_ts(seconds).alias("published_at"))


@query("ts_from_post_url", f"""
 SELECT event_id, {ts("make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000)")} AS published_at FROM events""")
def ts_from_post_url(desk: Desk):
    url = F.concat(F.lit("https://www.ptt.cc/bbs/Stock/M."), epoch_seconds(c("ts")).cast("string"), F.lit(".A.1F.html"))
    return desk.table("events").select("event_id", dates.ts_from_post_url(url).alias("published_at"))


@query("date_from_url", f"""
 SELECT event_id, {ts("TRY_CAST(CASE WHEN value < 100 THEN strftime(ts, '%Y-%m-') || lpad(CAST(CAST(floor(value) AS INT) AS VARCHAR), 2, '0') END AS TIMESTAMP)")}
   AS published_at FROM events""")
def date_from_url(desk: Desk):
    number = F.floor("value").cast("string")
    url = F.concat(F.lit("https://edition.cnn.com/"), F.date_format("ts", "yyyy/MM/"),
                   F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number), F.lit("/business/x"))
    return desk.table("events").select("event_id", dates.date_from_url(url).alias("published_at"))


@query("parse_iso_multi", f"""
 SELECT event_id, {ts('''CASE WHEN value > 200 THEN NULL
   WHEN event_type = 'signup' THEN ts WHEN event_type = 'purchase' AND value < 50 THEN date_trunc('day', ts)
   ELSE date_trunc('second', ts) END''')} AS published_at FROM events""")
def parse_iso_multi(desk: Desk):
    kind, second = c("event_type"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    written = (
        F.when(c("value") > 200, F.concat(F.lit("on "), second))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == "click", F.concat(second, F.lit("Z"))).when(kind == "view", F.concat(second, F.lit("+08:00")))
        .when(kind == "error", F.concat(second, F.lit("-0500")))
        .when(c("value") < 50, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return desk.table("events").select("event_id", dates.parse_iso(written).alias("published_at"))


# Every text is also read with the rules of the next source, so that the fall-through branches are used.
_NEXT = {"ptt": "cnyes", "cnyes": "reddit", "reddit": "cnn", "cnn": "wsj", "wsj": "ptt"}
_NEXT_SQL = "CASE source_name " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _NEXT.items()) + " END"


@query("parse_date_by_source", f"""
 SELECT raw_id, source_name, {ts(parse_date("t", "source_name"))} AS published_at, {ts(parse_date("t", "other"))} AS by_other_source
 FROM (SELECT raw_id, source_name, raw_payload ->> '$.published_at' AS t, {_NEXT_SQL} AS other FROM v_raw_articles)""")
def parse_date_by_source(desk: Desk):
    written = F.get_json_object("raw_payload", "$.published_at")
    read = lambda source: dates.parse_date_by_source(written, source)
    return desk.raw_articles().select("raw_id", "source_name", read(c("source_name")).alias("published_at"),
                                      read(config.lookup(c("source_name"), _NEXT)).alias("by_other_source"))


@query("offset_warning", """
 SELECT source_name, count(*) FILTER (WHERE source_name = 'cnyes') AS dropped_offsets, count(*) AS dates
 FROM v_articles GROUP BY 1""")
def offset_warning(desk: Desk):
    name = config.lookup(c("source_id").cast("string"), {"1": "ptt", "2": "cnyes", "3": "reddit", "4": "cnn", "5": "wsj"})
    written = F.concat(F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss"),
                       F.when(c("source_id") == 2, "+08:00").when(c("source_id") == 3, "Z").otherwise("+00:00"))
    return desk.articles().groupBy(name.alias("source_name")).agg(
        F.count_if(dates.has_offset(written)).alias("dropped_offsets"), F.count(F.lit(1)).alias("dates"))


@query("pii_hash", """
 SELECT article_id, substr(sha256('change-me-in-production:' || author), 1, 16) AS author_hash FROM v_articles""")
def pii_hash(desk: Desk):
    return desk.articles().select("article_id", pii.pii_hash(c("author")).alias("author_hash"))


@query("mask_authors", """
 SELECT 'articles' AS table_name, article_id AS row_id, substr(sha256('change-me-in-production:' || author), 1, 16) AS author,
   substr(sha256('change-me-in-production:' || author), 1, 16) AS masked_again FROM v_articles
 UNION ALL SELECT 'comments', comment_id, substr(sha256('change-me-in-production:' || author), 1, 16),
   substr(sha256('change-me-in-production:' || author), 1, 16) FROM v_comments""")
def mask_authors(desk: Desk):
    once = pii.mask_author(c("author"))
    rows = desk.articles().select(F.lit("articles").alias("table_name"), c("article_id").alias("row_id"), once.alias("author"))
    rows = rows.unionByName(desk.comments().select(
        F.lit("comments").alias("table_name"), c("comment_id").alias("row_id"), once.alias("author")))
    return rows.withColumn("masked_again", pii.mask_author(c("author")))


@query("market_for_source", """
 SELECT doc_id, CASE source WHEN 'src0' THEN 'TW' WHEN 'src1' THEN 'US' END AS market_code FROM documents""")
def market_for_source(desk: Desk):
    name = config.lookup(c("source"), {"src0": "ptt", "src1": "wayback_wsj", "src2": "elsewhere"})
    return desk.table("documents").select("doc_id", config.market_for_source(name).alias("market_code"))


_NUMBER = """CASE WHEN value < 10 THEN CAST(CAST(floor(value) AS INT) AS STRING)
  WHEN value < 20 THEN concat('-', CAST(CAST(floor(value) AS INT) AS STRING)) WHEN value < 30 THEN concat(CAST(user_id AS STRING), '.5')
  WHEN value < 40 THEN concat(CAST(user_id AS STRING), 'e3') WHEN value < 50 THEN concat('99999999999', CAST(user_id AS STRING))
  WHEN value < 60 THEN event_type END"""


@query("guarded_cast", f"""
 SELECT event_id, CAST(CASE WHEN regexp_matches(t, '^-?[0-9]+$') THEN TRY_CAST(t AS INTEGER) END AS BIGINT) AS as_int,
   CASE WHEN regexp_matches(t, '^-?[0-9]+(\\.[0-9]+)?$') THEN TRY_CAST(t AS DOUBLE) END AS as_float,
   strftime(CASE WHEN regexp_matches(d, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}')
     THEN TRY_CAST(d AS TIMESTAMP) END, '%Y-%m-%d %H:%M:%S.%f') AS as_time
 FROM (SELECT event_id, {_NUMBER.replace('STRING', 'VARCHAR')} AS t,
   CASE WHEN value > 90 THEN strftime(ts, '%Y-%m-%d') WHEN value > 80 THEN strftime(ts, '%Y-%m-31 %H:%M:%S') || 'x'
        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS d FROM events)""")
def guarded_cast(desk: Desk):
    number = F.expr(_NUMBER)
    written = (F.when(c("value") > 90, F.date_format("ts", "yyyy-MM-dd"))
               .when(c("value") > 80, F.date_format("ts", "yyyy-MM-'31' HH:mm:ss'x'"))
               .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return desk.table("events").select("event_id", text.guarded_int(number).alias("as_int"),
                                       text.guarded_float(number).alias("as_float"),
                                       dates.guarded_timestamp(written).alias("as_time"))


@query("json_extract", """
 SELECT event_id, nullif(trim(props ->> '$.k'), '') AS k, nullif(trim(props ->> '$.none'), '') AS missing FROM events""")
def json_extract(desk: Desk):
    field = lambda name: text.blank_to_null(F.get_json_object("props", f"$.{name}"))
    return desk.table("events").select("event_id", field("k").alias("k"), field("none").alias("missing"))


@query("blank_removed", """
 SELECT comment_id, CASE WHEN author = 'system' THEN '' ELSE message END AS body FROM v_comments""")
def blank_removed(desk: Desk):
    body = F.when(c("author") == "system", F.when(F.length("message") > 100, "[removed]").otherwise("[deleted]")).otherwise(
        c("message"))
    return desk.comments().select("comment_id", text.blank_removed(body).alias("body"))


@query("skip_keywords", "SELECT event_id, event_type || ' ' || user_id AS title FROM events WHERE value < 100")
def skip_keywords(desk: Desk):
    title = F.concat(F.when(c("value") >= 200, "[公告] ").when(c("value") >= 150, "今日盤後閒聊 ").when(
        c("value") >= 100, "[情報] ").otherwise(""), c("event_type"), F.lit(" "), c("user_id").cast("string"))
    return desk.table("events").select("event_id", title.alias("title")).where(~text.has_skip_keyword(c("title")))


@query("section_filter", """
 SELECT event_id, 'https://edition.cnn.com/2024/01/02/' || CASE event_type WHEN 'click' THEN 'business' ELSE 'tech' END || '/'
   || event_id AS url FROM events WHERE event_type IN ('click', 'view')""")
def section_filter(desk: Desk):
    section = config.lookup(c("event_type"), {"click": "business", "view": "tech", "error": "sport",
                                              "purchase": "business-travel", "signup": "style"})
    url = F.concat_ws("/", F.lit("https://edition.cnn.com/2024/01/02"), section, c("event_id").cast("string"))
    return desk.table("events").select("event_id", url.alias("url")).where(text.in_section(c("url")))


# Page addresses with more noise: upper-case scheme and host, default ports, blanks and escapes in the query.
_NOISY = """concat(CASE WHEN page_id > 100 THEN replace(replace(url, 'http://', 'HTTP://'), '.example.', '.EXAMPLE.')
   ELSE replace(url, '.com/', '.com:443/') END,
  CASE WHEN contains(url, '#') THEN 'x=1' WHEN contains(url, '?') THEN '&b=%C3%A9+f&c=&UTM_ID=7&d~=a*b&e=50%&f' ELSE '' END)"""
_PAIR_NAME = "CASE WHEN contains(p, '=') THEN split_part(p, '=', 1) ELSE p END"
_PAIR_VALUE = "CASE WHEN contains(p, '=') THEN substr(p, instr(p, '=') + 1) ELSE '' END"
_DEC = lambda x: f"url_decode(regexp_replace(replace({x}, '+', ' '), '%($|[^0-9A-F])', '%25\\1', 'g'))"
_ENC = lambda x: f"replace(url_encode({_DEC(x)}), '%20', '+')"


@query("canonical_url", f"""
 SELECT page_id, 'https://' || regexp_replace(lower(host), ':(443|80)$', '') || CASE WHEN path = '' THEN '/' WHEN length(path) > 1
   THEN rtrim(path, '/') ELSE path END || CASE WHEN q = '' THEN '' ELSE '?' || q END AS url
 FROM (SELECT page_id, regexp_extract(u, '^[A-Za-z]+://([^/?#]+)', 1) AS host,
   regexp_extract(u, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1) AS path,
   array_to_string(list_transform(list_filter(string_split(regexp_extract(u, '[?]([^#]*)', 1), '&'),
     lambda p: p <> '' AND NOT list_contains({urls.TRACKING_PARAMS!r}, lower({_DEC(_PAIR_NAME)}))),
     lambda p: {_ENC(_PAIR_NAME)} || '=' || {_ENC(_PAIR_VALUE)}), '&') AS q
  FROM (SELECT page_id, {_NOISY} AS u FROM pages))""")
def canonical_url(desk: Desk):
    return desk.table("pages").select("page_id", urls.canonical_url(F.expr(_NOISY)).alias("url"))


@query("clean_body_lines", r"""
 SELECT comment_id, array_to_string(list_transform(list_filter(string_split(trim(message, ' ' || chr(10) || chr(9) || chr(13)), chr(10)),
   lambda x: trim(x) <> ''), lambda x: trim(x)), chr(10)) AS body FROM v_comments""")
def clean_body_lines(desk: Desk):
    body = F.concat(F.lit("\n  "), F.replace("message", F.lit("\n"), F.lit("\n: quoted line\n   \n")),
                    F.lit("\n※ 引述 someone\nhttps://example.com/x\n"))
    return desk.comments().select("comment_id", text.clean_body_lines(body).alias("body"))


@query("min_length_gate", """
 SELECT comment_id, CASE WHEN length(message) > 50 THEN message END AS news, CASE WHEN length(message) >= 50 THEN message END AS page,
   CASE WHEN length(message) >= 100 THEN message END AS archive FROM v_comments""")
def min_length_gate(desk: Desk):
    gate = lambda chars, name: text.at_least(c("message"), chars).alias(name)
    return desk.comments().select("comment_id", gate(51, "news"), gate(50, "page"), gate(100, "archive"))


@query("content_fallback", """
 SELECT page_id, CASE WHEN length(html) >= 1500 THEN html ELSE 'page ' || page_id END AS content,
   list_extract(string_split(regexp_replace(url, '/+$', ''), '/'), -1) AS title FROM pages""")
def content_fallback(desk: Desk):
    body = text.at_least(c("html"), 1500)
    return desk.table("pages").select(
        "page_id", F.coalesce(body, F.concat(F.lit("page "), c("page_id").cast("string"))).alias("content"),
        F.coalesce(F.lit(None).cast("string"), text.last_path_segment(c("url"))).alias("title"))


@query("title_suffix", r"""
 SELECT event_id, event_type || ' ' || user_id AS title FROM events""")
def title_suffix(desk: Desk):
    suffix = config.lookup(c("event_type"), {"signup": " - CNN", "click": " | CNN", "view": " - WSJ", "error": " | WSJ - CNN",
                                             "purchase": ""})
    # Suffixes are cut in a fixed order, so only a chain in that order goes altogether.
    title = F.concat(c("event_type"), F.lit(" "), c("user_id").cast("string"),
                     F.when(c("event_type") == "error", " | WSJ | CNN").otherwise(suffix))
    return desk.table("events").select("event_id", text.strip_title_suffix(title).alias("title"))


@query("model_text", """
 SELECT article_id, length(title || ' ' || content) AS chars, substr(title || ' ' || content, 1, 1000) AS model_input,
   substr(title || ' ' || content, 1, 800) AS label_input FROM v_texts""")
def model_text(desk: Desk):
    t, b = c("title"), c("content")
    return desk.texts().select("article_id", F.length(text.full_text(t, b)).alias("chars"),
                               text.model_text(t, b).alias("model_input"),
                               text.model_text(t, b, text.LABEL_TEXT_CHARS).alias("label_input"))
