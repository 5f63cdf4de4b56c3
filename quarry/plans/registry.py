"""Registration of queries with their DuckDB SQL."""

from __future__ import annotations

from .views import with_views

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers f(spark, sf_dir) under its name; sql may name views and tables as {name}."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = with_views(sql)
        return f

    return put
