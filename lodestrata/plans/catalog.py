"""All queries of the engine and their SQL twins, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


def cases(spark, rows: list[tuple], schema: str):
    """A table of given rows."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def cases_sql(rows: list[tuple], names: str) -> str:
    """The same as SQL; strings, numbers, truth values and nulls."""

    def one(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(one(v) for v in r) + ')' for r in rows)}) AS t({names}))"


# Every module registers its queries when it is imported.
from . import graphs, jobs, models, scalars, sinks, store, web  # noqa: E402, F401
