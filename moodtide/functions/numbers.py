"""Rounding that does not depend on the order in which a distributed sum was added up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def settled(c: Column, digits: int) -> Column:
    """Round half up after cutting the noise of floating sums, so that ties fall the same way on every run."""
    return F.round(F.round(c, digits + 6), digits)


def numeric(c: Column, precision: int, scale: int) -> Column:
    """Store a measure as the warehouse column ``NUMERIC(precision, scale)``."""
    return F.round(c, scale + 6).cast(f"decimal({precision},{scale})")


def weighted_avg(value: Column, weight: Column) -> Column:
    """Sum(value * weight) / Sum(weight); null when nothing was weighed.

    The products are exact decimals. A null value drops out of the numerator only, its weight still counts.
    """
    total = F.sum(value * weight).cast("double")
    return F.try_divide(total, F.nullif(F.sum(weight), F.lit(0)).cast("double"))
