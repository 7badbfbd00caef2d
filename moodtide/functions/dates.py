"""Date and time parsing. Every result is a UTC timestamp; unreadable text gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: which source delivers which date format -----------------------
LOCAL_TIME_SOURCE, LOCAL_ZONE = "ptt", "Asia/Taipei"
EPOCH_SOURCE = "reddit"
MAIL_DATE_SOURCES = ["cnn", "wsj", "marketwatch", "wayback_cnn", "wayback_wsj"]
_DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
_CLOCK = r"[0-9]{2}:[0-9]{2}:[0-9]{2}"
_MAIL_DATE = rf"[A-Za-z]{{3}},\s+([0-9]{{1,2}}\s+[A-Za-z]{{3}}\s+[0-9]{{4}}\s+{_CLOCK})"
# ---------------------------------------------------------------------------------

_FRACTION = r"(?:\.([0-9]{1,6}))"
_OFFSET = r"[+-][0-9]{2}:?[0-9]{2}(?::?[0-9]{2})?|Z"


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds; values above 1e12 are milliseconds."""
    s = seconds.cast("double")
    micros = F.when(s > 1e12, s * F.lit(1e3)).otherwise(s * F.lit(1e6))
    return F.timestamp_micros(F.rint(micros).try_cast("bigint"))


def ts_from_post_url(url: Column) -> Column:
    """Forum posts carry their creation second in the address."""
    return epoch_to_ts(F.regexp_extract(url, r"M\.([0-9]+)\.", 1).try_cast("bigint"))


def date_from_url(url: Column) -> Column:
    day = F.regexp_extract(url, r"/([0-9]{4}/[0-9]{2}/[0-9]{2})/", 1)
    return F.try_to_timestamp(F.nullif(day, F.lit("")), F.lit("yyyy/MM/dd"))


def _clock_text(text: Column) -> Column:
    """First 19 characters with a blank between day and clock."""
    return F.translate(F.substring(text, 1, 19), "T", " ")


def parse_iso(text: Column, *, plain_clock: bool = True, date_only: bool = True) -> Column:
    """ISO text; an offset is read and dropped, not applied.

    ``plain_clock`` also accepts a clock without zone mark, ``date_only`` a bare day.
    """
    zoned = F.regexp_extract(text, rf"^([0-9-]+T[0-9:]+{_FRACTION}?)(?:{_OFFSET})$", 1)
    readings = [F.try_to_timestamp(zoned, F.lit("yyyy-M-d'T'H:m:s[.SSSSSS]"))]
    if plain_clock:
        readings += [F.try_to_timestamp(text, F.lit("yyyy-M-d'T'H:m:s")), F.try_to_timestamp(text, F.lit("yyyy-M-d H:m:s"))]
    if date_only:
        readings.append(F.try_to_timestamp(text, F.lit("yyyy-M-d")))
    return F.coalesce(*readings)


def parse_date_by_source(text: Column, source: Column) -> Column:
    """Raw date text, read the way the named source writes it; other text falls through to ISO."""
    day_clock = rf"^{_DAY}[T ]{_CLOCK}"
    local = F.to_utc_timestamp(F.try_to_timestamp(_clock_text(text), F.lit("yyyy-MM-dd HH:mm:ss")), LOCAL_ZONE)
    epoch = F.timestamp_micros(F.rint(text.try_cast("double") * F.lit(1e6)).try_cast("bigint"))
    mail = F.regexp_replace(F.regexp_extract(text, f"^{_MAIL_DATE}", 1), r"\s+", " ")
    iso = (F.when(text.rlike(day_clock), F.try_to_timestamp(_clock_text(text), F.lit("yyyy-MM-dd HH:mm:ss")))
           .when(text.rlike(f"^{_DAY}"), F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd"))))
    return (
        F.when(text.isNull() | (F.trim(text) == ""), F.lit(None).cast("timestamp"))
        .when((source == LOCAL_TIME_SOURCE) & text.rlike(day_clock), local)
        .when((source == EPOCH_SOURCE) & text.rlike(r"^[0-9]+(\.[0-9]+)?$"), epoch)
        .when(source.isin(MAIL_DATE_SOURCES) & text.rlike(f"^{_MAIL_DATE}"),
              F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss")))
        .otherwise(iso)
    )


def has_offset(text: Column) -> Column:
    """True when a date text carries a non-zero offset that parsing drops."""
    return text.rlike(r"[0-9]{2}:[0-9]{2}(\.[0-9]+)?[+-](?!00:?00)[0-9]{2}:?[0-9]{2}$")


def guarded_timestamp(text: Column) -> Column:
    """Cast only text that starts like a day with a clock."""
    return F.when(text.rlike(rf"^{_DAY}[T ]{_CLOCK}"), text.try_cast("timestamp_ntz"))


def snapshot_stamp(stamp: Column) -> Column:
    """Archive stamp ``yyyyMMddHHmmss``; a short one is filled with zeros, a bad clock keeps the day."""
    filled = F.rpad(F.substring(stamp, 1, 14), 14, "0")
    return F.when(F.length(stamp) >= 8, F.coalesce(
        F.try_to_timestamp(filled, F.lit("yyyyMMddHHmmss")),
        F.try_to_timestamp(F.substring(stamp, 1, 8), F.lit("yyyyMMdd")),
    ))
