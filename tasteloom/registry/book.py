"""The list of queries: a name, a callable (spark, folder) -> DataFrame, and SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tasteloom.registry.tables import with_tables

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str | None


BOOK: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a callable; the SQL may use the tables of ``tables.TABLES``."""

    def add(run: Run) -> Run:
        if name in BOOK:
            raise ValueError(f"{name} is registered twice")
        BOOK[name] = Query(run, with_tables(sql) if sql else None)
        return run

    return add
