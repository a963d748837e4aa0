"""Property-graph operators over edge tables (src, dst, weight)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_table, stage_table


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, weights of parallel edges summed."""
    both = edges.select("src", "dst", "weight").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return both.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def communities(edges: DataFrame, resolution: float = 1.0, tolerance: float = 1e-4) -> DataFrame:
    """(node, community) by modularity moves over joins, to convergence.

    In each round half of the nodes, drawn by hash, move to the neighbouring
    community of greatest gain if it is greater than that of staying; the halves
    take turns, so neighbours don't swap. Rounds end when neither half moves or
    the modularity no longer rises by more than ``tolerance``. Then communities become nodes and the moves
    are repeated, until no two communities join. Each round's labels are a
    written table that replaces the one before.
    """
    e = stage_table(undirected(edges), "edges")
    map_to = None
    while True:
        labels = _move(e, resolution, tolerance)
        if map_to is None:
            map_to = stage_table(labels, "communities")
        else:
            joined = map_to.join(labels.select(F.col("node").alias("community"), F.col("community").alias("up")), "community", "left")
            map_to = stage_table(joined.select("node", F.coalesce("up", "community").alias("community")), "communities", replaces=map_to)
        a, b = labels.select(F.col("node").alias("src"), F.col("community").alias("s")), labels.select(F.col("node").alias("dst"), F.col("community").alias("d"))
        n, fewer = labels.count(), labels.select("community").distinct().count()
        if n == fewer:
            return map_to
        e = stage_table(e.join(a, "src").join(b, "dst").groupBy(F.col("s").alias("src"), F.col("d").alias("dst")).agg(F.sum("weight").alias("weight")), "edges", replaces=e)


def _move(e: DataFrame, resolution: float, tolerance: float) -> DataFrame:
    degree = stage_table(e.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("k")), "degree")
    total = degree.agg(F.sum("k")).first()[0] or 1
    labels = stage_table(degree.select("node", F.col("node").alias("community"), "k", F.lit(False).alias("moved")), "labels")
    quality = _quality(e, labels, total, resolution)
    turn, idle = 0, 0
    while idle < 2:
        links = e.filter("src <> dst").join(labels.select(F.col("node").alias("dst"), F.col("community").alias("c")), "dst").groupBy(F.col("src").alias("node"), "c").agg(F.sum("weight").alias("w"))
        size = labels.groupBy(F.col("community").alias("c")).agg(F.sum("k").alias("sum_k"))
        gain = F.col("w") - resolution * F.col("k") * (F.col("sum_k") - F.when(F.col("c") == F.col("community"), F.col("k")).otherwise(0)) / total
        best = links.join(size, "c").join(labels.drop("moved"), "node").select("node", "c", gain.alias("gain"), (F.col("c") == F.col("community")).alias("own"))
        best = best.groupBy("node").agg(F.max_by("c", F.struct("gain", "own", "c")).alias("best"), F.max("gain").alias("gain"), F.max(F.when(F.col("own"), F.col("gain"))).alias("stay"))
        moves = best.filter((F.pmod(F.xxhash64("node"), F.lit(2)) == turn) & (F.col("gain") > F.coalesce("stay", F.lit(0.0)) + 1e-9)).select("node", "best")
        after = stage_table(labels.join(moves, "node", "left").select("node", F.coalesce("best", "community").alias("community"), "k", F.col("best").isNotNull().alias("moved")), "labels")
        turn = 1 - turn
        if after.filter("moved").isEmpty():
            idle += 1
            drop_table(after)
            continue
        risen = _quality(e, after, total, resolution)
        if risen <= quality + tolerance:  # moves of one turn that spoil each other are taken back
            idle += 1
            drop_table(after)
            continue
        drop_table(labels)
        labels, quality, idle = after, risen, 0
    return labels.select("node", "community")


def _quality(e: DataFrame, labels: DataFrame, total: float, resolution: float) -> float:
    """Modularity of a labelling of the nodes of undirected edges."""
    a, b = labels.select(F.col("node").alias("src"), F.col("community").alias("s")), labels.select(F.col("node").alias("dst"), F.col("community").alias("d"))
    inside = e.join(a, "src").join(b, "dst").filter("s = d").agg(F.sum("weight")).first()[0] or 0
    k = labels.groupBy("community").agg(F.sum("k").alias("k")).agg(F.sum(F.col("k").cast("double") * F.col("k"))).first()[0] or 0.0
    return float(inside) / float(total) - resolution * float(k) / float(total) ** 2


def modularity(edges: DataFrame, membership: DataFrame) -> DataFrame:
    """(modularity,) of a partition."""
    e = undirected(edges)
    a, b = membership.select(F.col("node").alias("src"), F.col("community").alias("s")), membership.select(F.col("node").alias("dst"), F.col("community").alias("d"))
    per = e.join(a, "src").join(b, "dst").groupBy("s").agg(F.sum(F.when(F.col("s") == F.col("d"), F.col("weight")).otherwise(0)).alias("inside"), F.sum("weight").alias("k"))
    total = per.agg(F.sum("k").alias("m2"))
    return per.crossJoin(F.broadcast(total)).agg(F.sum(F.col("inside") / F.col("m2") - (F.col("k") / F.col("m2")) ** 2).alias("modularity"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, by spreading and jumping labels over written tables until none changes."""
    e = stage_table(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "edges")
    labels = stage_table(e.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.first("src")).alias("component")).withColumn("moved", F.lit(True)), "labels")
    while not labels.filter("moved").isEmpty():
        seen = e.join(labels.select(F.col("node").alias("dst"), "component"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("component").alias("near"))
        new = labels.join(seen, "node").select("node", "component", F.least("component", "near").alias("new"))
        jump = new.join(labels.select(F.col("node").alias("new"), F.col("component").alias("over")), "new", "left")
        to = F.least("new", F.coalesce("over", "new"))
        labels = stage_table(jump.select("node", to.alias("component"), (to != F.col("component")).alias("moved")), "labels", replaces=labels)
    return labels.select("node", "component")


def ancestors(up: DataFrame) -> DataFrame:
    """(node, ancestor): all nodes reached from each over edges (node, parent), by paths of doubled length until no pair is new; cycles end too."""
    known = stage_table(up.select("node", F.col("parent").alias("ancestor")).distinct(), "ancestors")
    n, before = known.count(), -1
    while n != before:
        further = known.join(known.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("over")), "ancestor").select("node", F.col("over").alias("ancestor"))
        known = stage_table(known.unionByName(further).distinct(), "ancestors", replaces=known)
        n, before = known.count(), n
    return known


def within_hops(edges: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """(node, depth): least number of steps from any seed (node), up to ``depth``."""
    seen = seeds.select("node").distinct().withColumn("depth", F.lit(0))
    front = seen
    for d in range(1, depth + 1):
        step = edges.join(front.select(F.col("node").alias("src")), "src").select(F.col("dst").alias("node")).distinct().join(seen.select("node"), "node", "left_anti")
        front = stage_table(step.withColumn("depth", F.lit(d)), "front")
        seen = seen.unionByName(front)
    return seen


def best_first(edges: DataFrame, seeds: DataFrame, max_depth: int, budget: int, batch: int = 1) -> DataFrame:
    """(site, node, depth, place): nodes of each site in the order of a best-first traversal over edges (site, src, dst, priority) from seeds (site, node, priority).

    Every round takes the best ``batch`` of each site's frontier, by priority,
    then depth, then the place of the node that led there, then the node, until
    ``budget`` nodes are taken or no frontier is left; 1 is the strict order,
    more the order of as many workers. Nodes beyond ``max_depth`` aren't followed.
    """
    order = [F.desc("priority"), "depth", "came", "node"]
    first = lambda df: df.withColumn("n", F.row_number().over(Window.partitionBy("site", "node").orderBy(*order))).filter("n = 1").drop("n")
    front = stage_table(first(seeds.select("site", "node", "priority", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("came"))), "frontier")
    taken = stage_table(front.select("site", "node", "depth", F.lit(0).cast("long").alias("place")).limit(0), "taken")
    done = 0
    while done < budget and not front.isEmpty():
        size = min(batch, budget - done)
        ranked = front.withColumn("r", F.row_number().over(Window.partitionBy("site").orderBy(*order)))
        now = stage_table(ranked.filter(F.col("r") <= size).select("site", "node", "depth", (F.col("r") + done).cast("long").alias("place")), "step")
        taken = stage_table(taken.unionByName(now), "taken", replaces=taken)
        led = now.filter(F.col("depth") < max_depth).select("site", F.col("node").alias("src"), (F.col("depth") + 1).alias("depth"), F.col("place").alias("came"))
        found = edges.join(led, ["site", "src"]).select("site", F.col("dst").alias("node"), "priority", "depth", "came")
        rest = ranked.filter(F.col("r") > size).drop("r").unionByName(found).join(taken.select("site", "node"), ["site", "node"], "left_anti")
        front = stage_table(first(rest), "frontier", replaces=front)
        done += size
    return taken


def neighbourhood(edges: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """Edges that touch each node (node), in either direction, at most ``most`` of each by weight."""
    out = edges.join(nodes.select(F.col("node").alias("src")), "src").select(F.col("src").alias("node"), F.col("dst").alias("other"), "weight")
    back = edges.join(nodes.select(F.col("node").alias("dst")), "dst").select(F.col("dst").alias("node"), F.col("src").alias("other"), "weight")
    w = Window.partitionBy("node").orderBy(F.desc("weight"), "other")
    return out.unionByName(back).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)
