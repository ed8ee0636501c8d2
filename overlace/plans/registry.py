"""All registered queries of the library and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from overlace.plans.fixtures import duckdb_sql, view

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}
#: A query's SQL as a common table expression of its name, for queries that build on others.
NESTED: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a view reader ``v`` (``v("f_ovl")``) as a query, with its SQL."""

    def register(make):
        def run(spark, sf_dir):
            return make(partial(view, spark, sf_dir))

        run.__name__, run.__doc__ = name, make.__doc__
        QUERIES[name] = run
        if sql:
            text = sql.strip()
            NESTED[name] = f"{name} AS ({text if text.lower().startswith('select') else 'WITH ' + text})"
            SQL[name] = duckdb_sql(sql)
        return make

    return register


def load() -> None:
    """Import every module of queries."""
    from overlace.plans import aggregates, graphs, intervals, overlaps, recipes, repair, seeds, sequences, streams  # noqa: F401
