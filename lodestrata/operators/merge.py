"""Writes of the relational store as DataFrame merges: first wins, last wins, replace, and fill where null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _extreme(df: DataFrame, keys: list[str], order: list[str], last: bool) -> DataFrame:
    """The first or last row of each key."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    pick = (F.max_by if last else F.min_by)(row, F.struct(*order, *[F.col(c).cast("string") for c in rest if c not in order]))
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``target`` with the rows whose key it lacks, the first of each key."""
    return target.unionByName(_extreme(rows, keys, order, last=False).join(target.select(*keys), keys, "left_anti").select(*target.columns))


def inserted(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``rows`` that ``insert_ignore`` would add."""
    return rows.select(*keys).distinct().join(target.select(*keys), keys, "left_anti")


def upsert(target: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``target`` with the last row of each key written over its own."""
    latest = _extreme(rows, keys, order, last=True)
    return target.join(latest.select(*keys), keys, "left_anti").select(*target.columns).unionByName(latest.select(*target.columns))


def add_up(target: DataFrame, rows: DataFrame, keys: list[str], count: str) -> DataFrame:
    """``target`` with the counts of rows added to those of their keys."""
    return target.select(*keys, count).unionByName(rows.select(*keys, count)).groupBy(*keys).agg(F.sum(count).alias(count))


def fill_from(target: DataFrame, column: str, on: str, source: DataFrame, key: str, value: str) -> DataFrame:
    """``target`` with nulls of ``column`` filled by the least value that ``source`` has under the key."""
    least = source.groupBy(F.col(key).alias(on)).agg(F.min(value).alias("_v"))
    return target.join(least, on, "left").withColumn(column, F.coalesce(column, "_v")).drop("_v").select(*target.columns)


def delete_missing(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` without the rows whose key no longer occurs."""
    return target.join(rows.select(*keys).distinct(), keys, "left_semi").select(*target.columns)
