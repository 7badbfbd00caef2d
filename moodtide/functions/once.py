"""Keep costly columns from being computed twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, *columns: str | Column) -> DataFrame:
    """A select whose results later filters see as plain columns.

    Catalyst moves a filter on a selected expression below the select, as a copy of that expression. For parsing a
    payload or walking a page that would double the work of the job; the row generator in between stops the move.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))
