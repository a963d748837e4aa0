"""Joins that the pipeline's steps share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_yet(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key hasn't been processed; a null key on the done side excludes nothing."""
    return df.join(done.filter(F.col(key).isNotNull()).select(key), key, "left_anti")


def resolve_urls(links: DataFrame, docs: DataFrame, url: str) -> DataFrame:
    """Adds ``target``: the least document known under a link's URL, null where there is none."""
    known = docs.groupBy(F.col("url_canonical").alias(url)).agg(F.min("document_id").alias("target"))
    return links.join(known, url, "left")


def within_places(a: DataFrame, b: DataFrame, group: str, place: str, other: str, width: int) -> DataFrame:
    """Pairs of one group whose places differ by at most ``width``.

    Both sides join on blocks of ``width`` places, so the join is an equi-join
    and a group of any length is spread over its blocks.
    """
    left = a.withColumn("_b", F.explode(F.array(*[F.floor(F.col(place) / width) + i for i in (-1, 0, 1)])))
    right = b.withColumn("_b", F.floor(F.col(other) / width))
    return left.join(right, [group, "_b"]).filter(F.abs(F.col(place) - F.col(other)) <= width).drop("_b")


def following(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, next_<value>): the value of the next greater key, its own for the last; numbered by ranges, not in one task."""
    from .passages import numbered

    n = numbered(df.select(key, value), key)
    after = n.select((F.col("rn") - 1).alias("rn"), F.col(value).alias("_next"))
    return n.join(after, "rn", "left").select(key, F.coalesce("_next", value).alias(f"next_{value}"))
