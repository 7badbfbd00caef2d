"""Registry of queries and of the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtide.functions.numbers import settled
from moodtide.sources.domain import Desk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    """A domain table in SQL; queries name it and get it as a WITH clause."""
    VIEWS[name] = sql


def with_views(sql: str) -> str:
    """Put the views a statement uses in front of it, in their order of definition."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(VIEWS[name])

    visit(sql)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in needed)
    return f"WITH {ctes}\n{sql}" if ctes else sql


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Result columns in three types only: text, whole number, rounded number."""
    out = []
    for field in df.schema:
        c, t = F.col(f"`{field.name}`"), field.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            c = settled(c.cast("double"), digits)
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c, ",")
        out.append(c.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, digits: int = 6):
    """Register ``fn(desk)`` under ``name``; without SQL the check is on the row count only."""
    def register(fn: Callable[[Desk], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: plain(fn(Desk(spark, folder)), digits)
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn
    return register


# -- SQL spelling of the result types -----------------------------------------------------
def settle(expr: str, p: int, s: int) -> str:
    """Round through a longer decimal first: a tie is then decided in decimals, not by the last bit of a float."""
    return f"CAST(CAST(({expr}) AS DECIMAL(38,{s + 6})) AS DECIMAL({p},{s}))"


def fx(expr: str, digits: int = 6) -> str:
    return f"CAST({settle(expr, 38, digits)} AS DOUBLE)"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def day(expr: str) -> str:
    return f"strftime(CAST({expr} AS DATE), '%Y-%m-%d')"


def dec(expr: str, p: int, s: int) -> str:
    """A stored measure: rounded to its column type."""
    return settle(expr, p, s)
