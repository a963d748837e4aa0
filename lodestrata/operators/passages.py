"""Selection, ranking and numbering of passages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def good(min_chars: int, min_score: int) -> Column:
    """The quality filter of all analyses: long enough, not negative, and scored."""
    return (F.char_length("text") >= min_chars) & (F.coalesce("is_negative", F.lit(0)) == 0) & (F.coalesce("impact_score", F.lit(0)) >= min_score)


def top_per(df: DataFrame, group: str, n: int, key: str = "segment_id") -> DataFrame:
    """Adds ``rank``: the n best of each group by score, ties by key."""
    w = Window.partitionBy(group).orderBy(F.desc(F.coalesce("impact_score", F.lit(0))), key)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def or_best(df: DataFrame, condition: Column, n: int, key: str = "segment_id") -> DataFrame:
    """Rows that meet the condition, or the n best by score where none does."""
    hit = df.filter(condition)
    none = hit.select(F.lit(1).alias("one")).limit(1).agg(F.count("*").alias("found"))
    best = df.orderBy(F.desc_nulls_last("impact_score"), key).limit(n).crossJoin(none).filter("found = 0").drop("found")
    return hit.unionByName(best)


def numbered(df: DataFrame, key: str) -> DataFrame:
    """Adds ``rn``, the place of each row in the order of its key.

    The rows are sorted by ranges and numbered within each, and each range's
    offset is the sum of the counts before it: one row a partition, never one
    task for all rows.
    """
    ordered = df.repartitionByRange(df.sparkSession.sparkContext.defaultParallelism, key).sortWithinPartitions(key).withColumn("_p", F.spark_partition_id())
    local = ordered.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(key)))
    counts = local.groupBy("_p").agg(F.count("*").alias("_n"))
    offsets = counts.select("_p", (F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_o"))
    return local.join(offsets, "_p").withColumn("rn", F.col("_o") + F.col("_r")).drop("_p", "_r", "_o")


def range_shards(df: DataFrame, key: str, n: int) -> DataFrame:
    """Adds ``shard``: contiguous shards of size total div n, the remainder in the last."""
    size = df.agg((F.count("*") / n).cast("long").alias("_size"))
    shard = F.when(F.col("_size") == 0, n - 1).otherwise(F.least(F.floor((F.col("rn") - 1) / F.greatest("_size", F.lit(1))), F.lit(n - 1)))
    return numbered(df, key).crossJoin(F.broadcast(size)).withColumn("shard", shard.cast("long")).drop("rn", "_size")


def heading_paths(df: DataFrame, group: str, order: str, level: str, text: str, levels: int = 6) -> DataFrame:
    """Adds ``path``: the headings under which each heading stands, itself the last.

    A heading ends all those of its own level or deeper. The last heading of
    every level comes from one window over the group; one stands in the path if
    it came after the last of each higher level.
    """
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    last = {n: F.last(F.when(F.col(level) == n, F.struct(F.col(order).alias("at"), F.col(text).alias("text"))), ignorenulls=True).over(w).alias(f"_h{n}") for n in range(1, levels + 1)}
    found = df.select("*", *last.values())
    kept = []
    for n in range(1, levels + 1):
        above = [F.coalesce(F.col(f"_h{m}")["at"] < F.col(f"_h{n}")["at"], F.lit(True)) for m in range(1, n)]
        stands = F.col(f"_h{n}").isNotNull()
        for a in above:
            stands = stands & a
        kept.append(F.when(stands, F.col(f"_h{n}")["text"]))
    return found.withColumn("path", F.concat_ws(" > ", *kept)).drop(*[f"_h{n}" for n in last])


def since_last(df: DataFrame, group: list[str], order: list[str], found: str) -> DataFrame:
    """Adds ``since``: rows of the group since its last row with ``found``, which itself has 0."""
    w = Window.partitionBy(*group).orderBy(*order)
    island = df.withColumn("_island", F.sum(F.col(found).cast("int")).over(w))
    place = F.row_number().over(Window.partitionBy(*group, "_island").orderBy(*order))
    return island.withColumn("since", place - F.when(F.col("_island") > 0, 1).otherwise(0)).drop("_island")


def spaced(df: DataFrame, group: list[str], order: list[str], asked: str, gap: int) -> DataFrame:
    """Adds ``start``: when each row of a group may start so that neighbours are ``gap`` apart, never before it asked.

    The earliest start of row i is the greatest of what any row j before it
    asked for plus ``gap`` for each row from j to i, so a running maximum gives it.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    n = df.withColumn("_n", F.row_number().over(w))
    latest = F.max(F.col(asked) - F.col("_n") * gap).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return n.withColumn("start", latest + F.col("_n") * gap).drop("_n")
