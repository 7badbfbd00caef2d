"""Author pseudonyms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodtide.config import pii_salt

HASH_CHARS = 16  # fixed value: hex digits kept of the digest


def pii_hash(author: Column, salt: str | None = None) -> Column:
    """Salted SHA-256, shortened; null stays null."""
    salted = F.concat(F.lit(f"{pii_salt() if salt is None else salt}:"), author)
    return F.substring(F.sha2(salted.cast("binary"), 256), 1, HASH_CHARS)


def mask_author(author: Column, salt: str | None = None) -> Column:
    """Hash plain names only: a 16-character value counts as hashed already, so a re-run changes nothing.
    An empty name has no pseudonym."""
    plain = author.isNotNull() & (F.length(author) != HASH_CHARS)
    return F.when(plain, F.when(author != "", pii_hash(author, salt))).otherwise(author)
