"""Queries over the given tables, each with the SQL that has to give the same rows."""


def load():
    from catalog import base, views  # noqa: F401
    from catalog import columns, landing, parsing, quality, serving, tables, prediction, operations, increments  # noqa: F401

    return base.QUERIES, base.ORACLES
