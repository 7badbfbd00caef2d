"""URL canonicalisation with built-in string and array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: query parameters that only track the reader -----------------
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "utm_name", "utm_id", "utm_brand", "utm_social", "utm_social-type",
    "fbclid", "gclid", "dclid", "msclkid", "yclid",
    "ref", "refsrc", "cid", "ocid", "src", "source",
    "mc_cid", "mc_eid",
    "icid", "ncid",
    "ampcid", "amp_js_v",
    "mod", "st",
]
# -------------------------------------------------------------------------------

_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]"


def _decode(text: Column) -> Column:
    """Form decoding that keeps a percent sign which does not start an escape."""
    return F.try_url_decode(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(text: Column) -> Column:
    """Form encoding; ``~`` stays as it is and ``*`` is escaped."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """One spelling per page: https, lower-case host, no default port, no tracking parameters,
    no trailing slash and no fragment. Anything that is not an absolute address stays unchanged."""
    address = F.substring_index(url, "#", 1)
    head = F.substring_index(address, "?", 1)
    raw_query = F.substring(address, F.length(head) + 2, F.length(address))
    rest = F.substring(head, F.instr(head, "://") + 3, F.length(head))
    raw_host = F.substring_index(rest, "/", 1)
    raw_path = F.substring(rest, F.length(raw_host) + 1, F.length(rest))
    host = F.regexp_replace(F.lower(raw_host), ":(443|80)$", "")

    def cut(path: Column) -> Column:
        return F.when(path.isin("", "/"), F.lit("/")).otherwise(F.rtrim(path, F.lit("/")))

    # Parameters of the last path part (";v=1") stay behind the path; a lone ";" names none and disappears.
    params = F.regexp_extract(raw_path, r"(?s)^(?:.*/)?[^/;]*(;.*)$", 1)
    before = F.substring(raw_path, F.lit(1), F.length(raw_path) - F.length(params))
    path = F.when(raw_path.contains(";"), F.concat(cut(before), F.when(params == ";", "").otherwise(params))).otherwise(
        cut(raw_path))

    pairs = F.filter(F.split(raw_query, "&"), lambda p: p != "")
    split_at = lambda p: F.when(F.instr(p, "=") > 0, F.instr(p, "=")).otherwise(F.length(p) + 1)
    decoded = F.transform(pairs, lambda p: F.struct(
        _decode(F.substring(p, F.lit(1), split_at(p) - 1)).alias("name"),
        _decode(F.substring(p, split_at(p) + 1, F.length(p))).alias("value")))
    kept = F.filter(decoded, lambda q: ~F.lower(q["name"]).isin(TRACKING_PARAMS))
    query = F.array_join(F.transform(kept, lambda q: F.concat(F.lit("&"), _encode(q["name"]), F.lit("="), _encode(q["value"]))), "")
    # The first "&" becomes the "?"; without a kept pair nothing is left.
    tail = F.when(raw_query == "", F.lit("")).otherwise(F.regexp_replace(query, "^&", "?"))
    return F.when(url.rlike(_ABSOLUTE), F.concat(F.lit("https://"), host, path, tail)).otherwise(url)
