"""Filling containers of a fixed capacity by multiway differencing.

Sizes are tokens of a public tokenizer. Items are dealt to groups by hash, each
of about ``WINDOWS`` containers' worth, and every group is packed in one task by
Karmarkar-Karp differencing into k windows: each item begins as a partial
partition of its own (one window holds it, the others are empty), and the two
partial partitions with the greatest imbalance are merged again and again, the
fullest windows of one with the emptiest of the other, which leaves k windows of
nearly equal sums. k begins at the least possible number, the group's total over
the capacity. A window that exceeds the capacity is divided anew with an emptier
one, trying every subset of their smaller items; k rises whenever one exceeds it
still.

An item larger than a container is first cut into full containers, which need
no packing, and a rest, which is packed like an item. Items of no size go
nowhere. The number of groups follows the total, so a group is bounded by its
size and not by the number of items: groups of very many small items are dealt
again into more groups.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table

#: Containers' worth of items in a group, and the most items wanted in one.
WINDOWS, ITEMS = 200, 4096


def difference(sizes: list[int], k: int) -> tuple[list[list[int]], int]:
    """(items of each of k windows, greatest sum) by multiway differencing."""
    if k == 1:
        return [list(range(len(sizes)))], sum(sizes)
    # a partial partition: sums descending without the zeros at the end, and the items of each sum
    heap = [(-s, i, [s], [[i]]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tag = len(sizes)
    while len(heap) > 1:
        _, _, a, ai = heapq.heappop(heap)
        _, _, b, bi = heapq.heappop(heap)
        na, nb = len(a), len(b)
        if na + nb <= k:
            sums, items = a + b, ai + bi
        else:
            # fullest with emptiest: windows beyond the sums of either are empty
            over = na + nb - k
            sums = a[: na - over] + b[: nb - over] + [x + y for x, y in zip(a[na - over :], reversed(b[nb - over :]))]
            items = ai[: na - over] + bi[: nb - over] + [x + y for x, y in zip(ai[na - over :], reversed(bi[nb - over :]))]
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, items = [sums[i] for i in order], [items[i] for i in order]
        if len(sums) == k and sums[-1] > 0:  # what all windows have in common makes no difference
            spread = sums[0] - sums[-1]
        else:
            spread = sums[0]
        heapq.heappush(heap, (-spread, tag, sums, items))
        tag += 1
    _, _, sums, items = heap[0]
    return items + [[] for _ in range(k - len(items))], sums[0]


#: Items of two windows that are divided anew by trying every subset; the smallest ones.
SUBSET_ITEMS = 14


#: Emptier windows that a window beyond the capacity is tried with.
PARTNERS = 400


def _divide(sizes: list[int], a: list[int], b: list[int]) -> tuple[int, list[int], list[int]]:
    """(greater sum, items, items): two windows divided as evenly as subsets of their smaller items allow."""
    free = sorted(a + b, key=sizes.__getitem__)[:SUBSET_ITEMS]
    left = set(free)
    a, b = [i for i in a if i not in left], [i for i in b if i not in left]
    sums = np.zeros(1, dtype=np.int64)
    for i in free:
        sums = np.concatenate([sums, sums + sizes[i]])
    in_a, in_b = sum(sizes[i] for i in a), sum(sizes[i] for i in b)
    most = np.maximum(sums + in_a, sums[-1] - sums + in_b)
    pick = int(np.argmin(most))
    for q, i in enumerate(free):
        (a if pick >> q & 1 else b).append(i)
    return int(most[pick]), a, b


def relieved(sizes: list[int], windows: list[list[int]], capacity: int) -> bool:
    """Divides the fullest window anew with emptier ones, again and again; whether all keep to the capacity at last."""
    sums = np.array([sum(sizes[i] for i in w) for w in windows], dtype=np.int64)
    while True:
        w = int(sums.argmax())
        if sums[w] <= capacity:
            return True
        for v in np.argsort(sums, kind="stable")[:PARTNERS].tolist():
            if v == w:
                continue
            most, a, b = _divide(sizes, windows[w], windows[v])
            if most <= capacity or most < sums[w] - 8:
                windows[w], windows[v] = a, b
                sums[w], sums[v] = sum(sizes[i] for i in a), sum(sizes[i] for i in b)
                break
        else:
            return False


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items of each container; no container exceeds the capacity."""
    if not sizes:
        return []
    k = max(1, math.ceil(sum(sizes) / capacity))
    while True:
        windows, most = difference(sizes, k)
        if most <= capacity or relieved(sizes, windows, capacity):
            return [w for w in windows if w]
        k += max(1, k // 200)


def containers(items: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(key, piece_no, start, tokens, container): where each piece of each item lies.

    Rows with the same key count once; null and zero sizes go nowhere.
    """
    sized = stage_table(items.select(F.col(key).alias("item"), F.col(size).cast("long").alias("size")).filter("item is not null and size > 0").dropDuplicates(["item"]), "sizes")
    full = sized.filter(F.col("size") >= capacity).select("item", F.explode(F.sequence(F.lit(0), (F.col("size") / capacity).cast("int") - 1)).alias("piece_no"))
    full = full.select("item", "piece_no", (F.col("piece_no").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("tokens"), F.concat_ws("-", F.lit("full"), F.hex(F.xxhash64("item")), "piece_no").alias("container"))
    rest = sized.select("item", (F.col("size") / capacity).cast("int").alias("piece_no"), (F.col("size") % capacity).alias("tokens")).filter("tokens > 0")
    total = rest.agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    groups = max(1, math.ceil((total.t or 0) / (capacity * WINDOWS)), math.ceil(total.n / ITEMS))

    def group(table: pa.Table) -> pa.Table:
        table = table.sort_by([("tokens", "descending"), ("item", "ascending")])
        tokens = table.column("tokens").to_pylist()
        name = np.empty(len(tokens), dtype=object)
        g = table.column("grp")[0].as_py()
        for w, members in enumerate(pack(tokens, capacity)):
            for i in members:
                name[i] = f"{g}-{w}"
        return table.drop_columns(["grp"]).append_column("container", pa.array(name.tolist(), pa.string()))

    kind = rest.schema["item"].dataType.simpleString()
    # a group's work is far greater than its bytes, by which tasks would be put together
    dealt = rest.withColumn("grp", F.pmod(F.xxhash64("item", F.lit(5)), F.lit(groups))).repartition(groups, "grp")
    packed = dealt.groupBy("grp").applyInArrow(group, f"item {kind}, piece_no int, tokens long, container string")
    packed = packed.select("item", "piece_no", (F.col("piece_no").cast("long") * capacity).alias("start"), "tokens", "container")
    return full.unionByName(packed).withColumnRenamed("item", key)
