"""The k most similar vectors of every vector, by NN-descent.

A neighbour graph is begun from several random partitions (signs of random
projections; every block is searched exhaustively) and then improved by rounds
of Spark joins of neighbours of neighbours: every vector is sent to its
neighbours, and all that meet at one vector are compared with each other. A
round's graph is a written table; rounds end when few lists change. Queries
enter the graph in their own blocks of the same partitions and walk greedily
until no beam changes.

Similarity is the cosine, of vectors normalised and kept as 16-bit floats (an
error of about 0.0005). Vectors that are null, of another length, all zero or
hold NaN or infinity take no part. Rows with the same key count once. A block
never exceeds ``BLOCK`` rows: one that would, as where many vectors are equal,
is split at random. A vector that is the neighbour of very many meets them in
groups of ``MEET``; each group has all of the vector's own neighbours.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_table, stage_table

#: Rows of a block, the mean rows wanted of one, and the least number of partitions.
BLOCK, MEAN_BLOCK, TREES = 4096, 1536, 4
#: Neighbours kept and followed, and the largest meeting.
WIDTH, MEET = 8, 48
#: Parts of a round's meetings, compared one after the other.
SLICES = 2


def unit_vectors(df: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """(key, id, q): usable vectors once each, normalised, as bytes of 16-bit floats; ``id`` is the key's hash."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            good = np.asarray(lists.is_valid()) & (np.asarray(lists.value_lengths().fill_null(0)) == dim)
            part = batch.filter(pa.array(good))
            if not part.num_rows:
                continue
            x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            norm = np.sqrt((x * x).sum(axis=1))
            ok = np.isfinite(norm) & (norm > 0)
            q = (x[ok] / norm[ok, None]).astype(np.float16)
            yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(ok)), pa.array([r.tobytes() for r in q], pa.binary())], names=["key", "q"])

    usable = df.select(F.col(key).cast("string").alias("key"), F.col(vector).cast("array<double>").alias("v")).filter("key is not null and v is not null")
    return usable.mapInArrow(run, "key string, q binary").withColumn("id", F.xxhash64("key")).dropDuplicates(["id"])


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float16).reshape(-1, dim).astype(np.float32)


def partition_bits(n: int) -> int:
    """Signs that a partition of ``n`` vectors has, for blocks of about ``MEAN_BLOCK`` rows."""
    return max(0, math.ceil(math.log2(max(1, n / MEAN_BLOCK))))


def _codes(vectors: DataFrame, dim: int, bits: int, trees: int) -> DataFrame:
    """(tree, code, id, q) of each vector in each partition."""
    planes = np.random.default_rng(7).standard_normal((trees, dim, max(bits, 1))).astype(np.float32)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            for t in range(trees):
                side = (x @ planes[t] > 0)[:, :bits]
                code = side @ (1 << np.arange(bits)) if bits else np.zeros(len(x))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, dtype=np.int32)), pa.array(code.astype(np.int64)), batch.column(0), batch.column(1)], names=["tree", "code", "id", "q"])

    return vectors.select("id", "q").mapInArrow(run, "tree int, code long, id long, q binary")


#: One entry of a packed list.
ENTRY = np.dtype([("nb", "<i8"), ("sim", "<f4")])
LISTS = "id long, list binary"


def _best(of: np.ndarray, neighbour: np.ndarray, sim: np.ndarray, rows: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, neighbours, similarities) of the best ``width`` distinct neighbours of each of ``rows``; ``of`` gives an entry's row."""
    order = np.lexsort((-sim, neighbour, of))
    of, neighbour, sim = of[order], neighbour[order], sim[order]
    new = np.ones(len(of), dtype=bool)
    new[1:] = (of[1:] != of[:-1]) | (neighbour[1:] != neighbour[:-1])
    of, neighbour, sim = of[new], neighbour[new], sim[new]
    order = np.lexsort((neighbour, -sim, of))
    of, neighbour, sim = of[order], neighbour[order], sim[order]
    start = np.searchsorted(of, np.arange(rows))
    keep = np.arange(len(of)) - start[of] < width
    ends = np.zeros(rows + 1, dtype=np.int32)
    np.cumsum(np.bincount(of[keep], minlength=rows), out=ends[1:])
    return ends, neighbour[keep], sim[keep].astype(np.float32)


def _lists(ids: np.ndarray, of: np.ndarray, neighbour: np.ndarray, sim: np.ndarray, width: int) -> pa.RecordBatch:
    """``LISTS`` of the best ``width`` distinct neighbours of each row, 12 bytes an entry; ``of`` gives the row in ``ids``."""
    ends, neighbour, sim = _best(of, neighbour, sim, len(ids), width)
    entries = np.empty(len(neighbour), dtype=ENTRY)
    entries["nb"], entries["sim"] = neighbour, sim
    lists = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer((ends * ENTRY.itemsize).astype(np.int32)), pa.py_buffer(entries.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(ids), lists], names=["id", "list"])


def _block_lists(coded: DataFrame, dim: int, width: int) -> DataFrame:
    """Exhaustive neighbours within each block of each partition."""
    sizes = coded.groupBy("tree", "code").agg(F.ceil(F.count("*") / F.lit(BLOCK * 3 // 4)).cast("int").alias("parts"))
    salted = coded.join(sizes, ["tree", "code"]).withColumn("part", F.pmod(F.xxhash64("id", "tree"), F.col("parts")))

    def block(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        x = _matrix(table.column("q"), dim)
        n = len(ids)
        k = min(width, n - 1)
        out = []
        for at in range(0, n, 1024):
            s = x[at : at + 1024] @ x.T
            rows = np.arange(len(s))
            s[rows, rows + at] = -2
            if k < 1:
                out.append(_lists(ids[at : at + 1024], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32), width))
                continue
            best = np.argpartition(s, n - k, axis=1)[:, n - k :]
            out.append(_lists(ids[at : at + 1024], np.repeat(rows, k), ids[best].ravel(), np.take_along_axis(s, best, 1).ravel(), width))
        return pa.Table.from_batches(out)

    return salted.select("tree", "code", "part", "id", "q").groupBy("tree", "code", "part").applyInArrow(block, LISTS)


def _merged(lists: DataFrame, width: int, before: DataFrame | None = None) -> DataFrame:
    """(id, nb, sim, fresh): one list for each id, of the best of all its lists; ``fresh`` are those that it has not in ``before``."""
    all_lists = lists.select("id", "list", F.lit(False).alias("old"))
    if before is not None:
        all_lists = all_lists.unionByName(before.select("id", "nb", "sim").mapInArrow(_packed, LISTS).select("id", "list", F.lit(True).alias("old")))
    together = all_lists.groupBy("id").agg(F.collect_list("list").alias("lists"), F.max_by("list", F.when(F.col("old"), 1)).alias("old"))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            got = [b"".join(x) for x in batch.column(1).to_pylist()]
            entries = np.frombuffer(b"".join(got), dtype=ENTRY)
            of = np.repeat(np.arange(n), np.array([len(x) for x in got], dtype=np.int64) // ENTRY.itemsize)
            ends, nb, sim = _best(of, entries["nb"], entries["sim"], n, width)
            kept = batch.column(2).to_pylist()
            old = np.frombuffer(b"".join(x or b"" for x in kept), dtype=ENTRY)["nb"]
            old_of = np.repeat(np.arange(n), np.array([len(x or b"") for x in kept], dtype=np.int64) // ENTRY.itemsize)
            row = np.repeat(np.arange(n), np.diff(ends))
            known = _pairs(row, nb, old_of, old)
            fresh = np.zeros(n + 1, dtype=np.int32)
            np.cumsum(np.bincount(row[~known], minlength=n), out=fresh[1:])
            ends = pa.array(ends)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, pa.array(nb)), pa.ListArray.from_arrays(ends, pa.array(sim)), pa.ListArray.from_arrays(pa.array(fresh), pa.array(nb[~known]))], names=["id", "nb", "sim", "fresh"]
            )

    return together.select("id", "lists", "old").mapInArrow(run, "id long, nb array<long>, sim array<float>, fresh array<long>")


def _packed(batches):
    for batch in batches:
        sizes = np.asarray(batch.column(1).value_lengths())
        of = np.repeat(np.arange(batch.num_rows), sizes)
        yield _lists(batch.column(0).to_numpy(), of, batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy(), int(sizes.max(initial=1)))


def _pairs(row: np.ndarray, value: np.ndarray, among_row: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Whether each (row, value) is among the others."""
    _, both = np.unique(np.concatenate([value, among]), return_inverse=True)
    m = np.int64(both.max(initial=0) + 1)
    return np.isin(row * m + both[: len(value)], among_row * m + both[len(value) :])


def _met(center: np.ndarray, ids: np.ndarray, x: np.ndarray, worst: np.ndarray, fresh: np.ndarray) -> list[pa.RecordBatch]:
    """Lists of those that meet at each center, of pairs with a fresh member; rows come in the order of the centers."""
    cut = np.flatnonzero(np.concatenate([[True], center[1:] != center[:-1]]))
    size = np.diff(np.append(cut, len(center)))
    out = []
    for m in np.unique(size):
        if m < 2:
            continue
        starts = cut[size == m]
        for at in range(0, len(starts), max(1, 4_000_000 // int(m * m))):
            s0 = starts[at : at + max(1, 4_000_000 // int(m * m))]
            rows = s0[:, None] + np.arange(m)
            y = x[rows]
            s = y @ y.transpose(0, 2, 1)
            better = s > worst[rows][:, :, None]
            better[:, np.arange(m), np.arange(m)] = False
            better &= fresh[rows][:, :, None] | fresh[rows][:, None, :]
            g, i, j = np.nonzero(better)
            if len(g):
                member, inverse = np.unique(ids[rows[g, i]], return_inverse=True)
                out.append(_lists(member, inverse, ids[rows[g, j]], s[g, i, j], WIDTH))
    return out


def _round(graph: DataFrame, vectors: DataFrame, dim: int) -> list[DataFrame]:
    """Lists from the comparison of all that meet at a common neighbour and did not before, one written table for each slice of the meetings."""
    edges = graph.select("id", F.explode("nb").alias("nb"), "fresh").select("id", "nb", F.array_contains("fresh", F.col("nb")).alias("fresh"))
    both = edges.select(F.col("id").alias("center"), F.col("nb").alias("id"), "fresh", F.lit(True).alias("own"))
    both = both.unionByName(edges.select(F.col("nb").alias("center"), "id", "fresh", F.lit(False).alias("own")))
    met = both.groupBy("center", "id").agg(F.min("fresh").alias("fresh"), F.max("own").alias("own"))
    crowd = met.groupBy("center").agg(F.ceil(F.sum((~F.col("own")).cast("int")) / F.lit(MEET - WIDTH)).cast("long").alias("parts"), F.max("fresh").alias("any"))
    met = met.join(crowd.filter("any"), "center").withColumn("parts", F.greatest("parts", F.lit(1)))
    part = F.when(F.col("own"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("id", "center"), F.col("parts"))))
    sent = met.select("center", F.explode(part).alias("part"), "id", "fresh")
    sent = stage_table(sent.select(F.xxhash64("center", "part").alias("spot"), "id", "fresh"), "meetings")
    worst = graph.select("id", F.when(F.size("sim") >= WIDTH, F.element_at("sim", WIDTH)).otherwise(F.lit(-1.0)).cast("float").alias("worst"))
    known = vectors.select("id", "q").join(worst, "id")
    partitions = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            spots = held.column(0).to_numpy()
            last = int(np.searchsorted(spots, spots[-1])) if len(spots) else 0
            if last:
                done, held = held.slice(0, last), held.slice(last)
                yield from _met(done.column(0).to_numpy(), done.column(1).to_numpy(), _matrix(done.column(2), dim), done.column(3).to_numpy(), done.column(4).to_numpy(zero_copy_only=False))
        if held is not None and held.num_rows:
            yield from _met(held.column(0).to_numpy(), held.column(1).to_numpy(), _matrix(held.column(2), dim), held.column(3).to_numpy(), held.column(4).to_numpy(zero_copy_only=False))

    out = []
    for part in range(SLICES):  # a slice's vectors are gone from the disk before the next one's are sent
        own = sent.filter(F.pmod("spot", F.lit(SLICES)) == part).join(known, "id").select("spot", "id", "q", "worst", "fresh")
        meeting = own.repartition(partitions, "spot").sortWithinPartitions("spot")
        out.append(stage_table(meeting.mapInArrow(run, LISTS), "met"))
    drop_table(sent)
    return out


def neighbour_graph(vectors: DataFrame, dim: int, trees: int = TREES, least_change: float = 0.01) -> DataFrame:
    """(id, nb, sim): up to ``WIDTH`` neighbours of each vector of ``unit_vectors``, the most similar first.

    More vectors make more blocks, and a block then holds fewer of a vector's
    neighbours; so there are at least as many partitions as signs in one. Rounds
    end when at most ``least_change`` of the lists change.
    """
    n = vectors.count()
    bits = partition_bits(n)
    graph = stage_table(_merged(_block_lists(_codes(vectors, dim, bits, max(trees, bits)), dim, WIDTH), WIDTH), "graph")
    changed = n if bits else 0  # one block: already exhaustive
    while changed > least_change * n:
        met = _round(graph, vectors, dim)
        graph = stage_table(_merged(reduce(DataFrame.unionByName, met), WIDTH, graph), "graph", replaces=graph)
        for lists in met:
            drop_table(lists)
        changed = graph.filter(F.size("fresh") > 0).count()
    return graph.drop("fresh")


def nearest(df: DataFrame, key: str, vector: str, dim: int, k: int = 5) -> DataFrame:
    """(key, neighbour, rank, similarity): the k most similar other vectors of each usable vector."""
    vectors = stage_table(unit_vectors(df, key, vector, dim), "vectors")
    graph = neighbour_graph(vectors, dim)
    pairs = graph.select("id", F.posexplode(F.slice(F.arrays_zip("nb", "sim"), 1, k)).alias("rank", "e")).select("id", F.col("e.nb").alias("nb"), (F.col("rank") + 1).alias("rank"), F.col("e.sim").alias("similarity"))
    names = vectors.select("id", "key")
    return (
        pairs.join(names.withColumnRenamed("key", key), "id")
        .join(names.select(F.col("id").alias("nb"), F.col("key").alias("neighbour")), "nb")
        .select(key, "neighbour", "rank", "similarity")
    )


def _entries(vectors: DataFrame, queries: DataFrame, dim: int, beam: int, trees: int = TREES) -> DataFrame:
    """(qid, id): the ``beam`` most similar vectors of each query's own block in each random partition.

    A code that no vector has is replaced by an occupied one with the longest
    common prefix, so every query enters in every partition. Of a block split at
    random a query searches one part.
    """
    bits = partition_bits(vectors.count())
    coded = _codes(vectors, dim, bits, trees)
    sizes = stage_table(coded.groupBy("tree", "code").agg(F.ceil(F.count("*") / F.lit(BLOCK * 3 // 4)).cast("int").alias("parts")), "blocks")
    cut = F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("cut")
    prefix = F.expr("shiftright(code, cut)").alias("prefix")
    reached = sizes.select("tree", "code", "parts", cut).select("tree", "cut", prefix, "code", "parts").groupBy("tree", "cut", "prefix").agg(F.min(F.struct("code", "parts")).alias("to"))
    asked = _codes(queries.select(F.col("qid").alias("id"), "q"), dim, bits, trees).select("tree", "code", F.col("id").alias("qid"), cut)
    best = asked.select("tree", "cut", prefix, "qid").join(reached, ["tree", "cut", "prefix"]).groupBy("tree", "qid").agg(F.min(F.struct("cut", "to")).alias("best"))
    into = best.select("tree", F.col("best.to.code").alias("code"), F.pmod(F.xxhash64("qid", "tree"), F.col("best.to.parts")).alias("part"), "qid")
    left = into.join(queries.select("qid", "q"), "qid").select("tree", "code", "part", "qid", "q")
    used = into.select("tree", "code", "part").distinct()
    right = coded.join(sizes, ["tree", "code"]).withColumn("part", F.pmod(F.xxhash64("id", "tree"), F.col("parts"))).join(used, ["tree", "code", "part"], "left_semi").select("tree", "code", "part", "id", "q")

    def block(asking: pa.Table, there: pa.Table) -> pa.Table:
        if not asking.num_rows or not there.num_rows:
            return pa.table({"qid": pa.array([], pa.int64()), "id": pa.array([], pa.int64())})
        qid, ids = asking.column("qid").to_numpy(), there.column("id").to_numpy()
        target, x = _matrix(asking.column("q"), dim), _matrix(there.column("q"), dim)
        k = min(beam, len(ids))
        best = [np.argpartition(target[at : at + 1024] @ x.T, len(ids) - k, axis=1)[:, len(ids) - k :] for at in range(0, len(qid), 1024)]
        return pa.table({"qid": np.repeat(qid, k), "id": ids[np.concatenate(best).ravel()]})

    by = ["tree", "code", "part"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(block, "qid long, id long").distinct()


def _far_links(vectors: DataFrame, dim: int, trees: int = TREES) -> DataFrame:
    """(id, nb): the most similar vectors of each vector within random samples, about ``MEAN_BLOCK`` rows each.

    Lists of the nearest alone hold together only what is close, and a walk ends
    in the first group that it meets; these lead from group to group.
    """
    n = vectors.count()
    parts = max(1, round(n / MEAN_BLOCK))
    drawn = vectors.select(F.explode(F.sequence(F.lit(0), F.lit(max(trees, partition_bits(n)) - 1))).alias("tree"), "id", "q")
    drawn = drawn.withColumn("code", F.pmod(F.xxhash64("id", "tree", F.lit(11)), F.lit(parts)))
    return _block_lists(drawn, dim, WIDTH).mapInArrow(_ends, "id long, nb long")


def _ends(batches):
    for batch in batches:
        got = batch.column(1).to_pylist()
        sizes = np.array([len(x) for x in got], dtype=np.int64) // ENTRY.itemsize
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), sizes)), pa.array(np.frombuffer(b"".join(got), dtype=ENTRY)["nb"])], names=["id", "nb"])


def search(graph: DataFrame, vectors: DataFrame, queries: DataFrame, dim: int, k: int = 5, beam: int = 96) -> DataFrame:
    """(qid, id, similarity): the k best of a greedy walk for each query (qid, q); the graph stays distributed.

    Walks begin at the best of the query's own blocks and follow edges and links
    of random samples, in both directions, of the ``beam`` best seen so far, each
    step two joins; they end when every vector of every beam has been followed.
    """
    edges = graph.select("id", F.explode("nb").alias("nb")).unionByName(_far_links(vectors, dim))
    linked = edges.unionByName(edges.select(F.col("nb").alias("id"), F.col("id").alias("nb"))).groupBy("id").agg(F.collect_set("nb").alias("nb"))
    nodes = stage_table(vectors.select("id", "q").join(linked, "id", "left"), "search_graph")
    # laid out once by id, so that the steps move only what they ask for
    nodes = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id").persist()

    def score(batches):
        for batch in batches:
            a, b = _matrix(batch.column(2), dim), _matrix(batch.column(3), dim)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((a * b).sum(axis=1))], names=["qid", "id", "similarity"])

    def scored(wanted: DataFrame) -> DataFrame:
        both = wanted.join(nodes.select("id", "q"), "id").join(queries.select("qid", F.col("q").alias("target")), "qid").select("qid", "id", "target", "q")
        return both.mapInArrow(score, "qid long, id long, similarity float").withColumn("followed", F.lit(False))

    from pyspark.sql import Window

    best_first = Window.partitionBy("qid").orderBy(F.desc("similarity"), "id")
    seen, walked = scored(_entries(vectors, queries, dim, beam)), None
    while True:
        seen = walked = stage_table(seen.withColumn("r", F.row_number().over(best_first)).filter(F.col("r") <= 4 * beam), "walk", replaces=walked)
        fresh = seen.filter((F.col("r") <= beam) & ~F.col("followed"))
        if fresh.isEmpty():
            break
        step = fresh.select("qid", "id").join(nodes.select("id", "nb"), "id").select("qid", F.explode("nb").alias("id")).distinct().join(seen.select("qid", "id"), ["qid", "id"], "left_anti")
        seen = seen.withColumn("followed", F.col("followed") | (F.col("r") <= beam)).drop("r").unionByName(scored(step))
    nodes.unpersist()
    return seen.filter(F.col("r") <= k).select("qid", "id", "similarity")
