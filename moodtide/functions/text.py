"""Column rules for titles, bodies and vote counts. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
SKIP_KEYWORDS = ["公告", "盤後閒聊", "盤中閒聊", "情報"]
SECTION_PATHS = ["/business/", "/markets/", "/economy/", "/money/", "/investing/", "/tech/", "/media/"]
REMOVED_MARKERS = ["[removed]", "[deleted]"]
QUOTE_MARK = "引述"
TITLE_SUFFIXES = [" - CNN", " | CNN", " - WSJ", " | WSJ"]
PUSH_BURST, PUSH_BURIED, PUSH_LIMIT = "爆", "XX", 100
MODEL_TEXT_CHARS, LABEL_TEXT_CHARS = 1000, 800
# ------------------------------------------------------------------------------

# White space as Python's str.strip() sees it (line breaks and wide blanks included).
_BLANK = r"[\s\u001c-\u001f\u0085\p{Z}]"


def strip(c: Column) -> Column:
    """Cut white space of any kind from both ends."""
    return F.regexp_replace(c, rf"^{_BLANK}+|{_BLANK}+$", "")


def blank_to_null(c: Column) -> Column:
    """Trim blanks; nothing left means null."""
    return F.nullif(F.trim(c), F.lit(""))


def push_decode(text: Column) -> Column:
    """Vote badge of a list page to a number; unreadable badges give null."""
    t = strip(text)
    number = lambda x: F.when(strip(x).rlike(r"^[+-]?[0-9]+$"), strip(x).try_cast("bigint"))
    return (
        F.when(t == PUSH_BURST, F.lit(PUSH_LIMIT).cast("bigint"))
        .when(t == PUSH_BURIED, F.lit(-PUSH_LIMIT).cast("bigint"))
        .when(t.startswith("X"), number(F.substring(t, 2, 1 << 30)) * F.lit(-10))
        .otherwise(number(t))
    )


def push_clamp(score: Column) -> Column:
    """Votes of the forum API: missing counts as 0, kept within the badge range."""
    return F.least(F.greatest(F.coalesce(score, F.lit(0)), F.lit(-PUSH_LIMIT)), F.lit(PUSH_LIMIT))


def blank_removed(body: Column) -> Column:
    """Bodies the forum marks as taken down become empty text."""
    return F.when(body.isin(REMOVED_MARKERS), F.lit("")).otherwise(body)


def has_skip_keyword(title: Column) -> Column:
    found = F.lit(False)
    for word in SKIP_KEYWORDS:
        found = found | title.contains(word)
    return found


def in_section(url: Column) -> Column:
    found = F.lit(False)
    for path in SECTION_PATHS:
        found = found | url.contains(path)
    return found


def clean_body_lines(body: Column) -> Column:
    """Own words of a post: without quote lines, quoted text, bare links and empty lines."""
    own = F.filter(
        F.split(strip(body), "\n"),
        lambda line: ~line.contains(QUOTE_MARK) & ~line.startswith(": ") & ~line.startswith("http")
        & (strip(line) != ""),
    )
    return F.array_join(F.transform(own, strip), "\n")


def at_least(text: Column, chars: int) -> Column:
    """Keep a text of at least ``chars`` characters, else null."""
    return F.when(F.length(text) >= chars, text)


def strip_title_suffix(title: Column) -> Column:
    """Cut the publisher's name off a page title, one suffix after the other."""
    for suffix in TITLE_SUFFIXES:
        title = F.regexp_replace(title, rf"{_BLANK}*\Q{suffix}\E\z", "")
    return title


def last_path_segment(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def full_text(title: Column, content: Column) -> Column:
    """Text that scoring reads; null when there is no title."""
    return F.concat(title, F.lit(" "), F.coalesce(content, F.lit("")))


def model_text(title: Column, content: Column, chars: int = MODEL_TEXT_CHARS) -> Column:
    """Input window of the sentence model."""
    return F.substring(full_text(title, content), 1, chars)


def title_matches(title: Column, keyword: str) -> Column:
    """Case-insensitive literal search; a missing title never matches."""
    return F.coalesce(F.contains(F.lower(title), F.lower(F.lit(keyword))), F.lit(False))


def guarded_int(c: Column) -> Column:
    return F.when(c.rlike(r"^-?[0-9]+$"), c.try_cast("int"))


def guarded_float(c: Column) -> Column:
    return F.when(c.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), c.try_cast("double"))
