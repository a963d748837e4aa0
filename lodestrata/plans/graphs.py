"""Queries over the property graph: nodes are documents, municipalities, parts and suppliers; edges come from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph
from ..session import stage_table, table
from .catalog import query
from .store import CHUNK_SQL, DOCS_SQL, SEG_SQL, chunks, docs, segments

EDGE_SQL = "e AS (SELECT l_suppkey AS src, l_partkey AS dst, count(*) AS weight FROM lineitem GROUP BY ALL)"


def supply(spark, sf):
    """Which supplier delivers which part, and how often."""
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")).agg(F.count("*").alias("weight"))


@query("gr_base_edges", f"""WITH {DOCS_SQL}, {SEG_SQL}, {CHUNK_SQL} SELECT DISTINCT 'HAS_DOCUMENT' AS rel, municipality_id AS src, CAST(document_id AS VARCHAR) AS dst FROM docs WHERE municipality_id IS NOT NULL
UNION ALL SELECT DISTINCT 'HAS_SEGMENT', CAST(document_id AS VARCHAR), segment_id FROM seg UNION ALL SELECT DISTINCT 'HAS_CHUNK', segment_id, chunk_id FROM ch WHERE segment_id IS NOT NULL""")
def gr_base_edges(spark, sf):
    """Edges of the containment hierarchy, each once."""
    edge = lambda df, rel, a, b: df.select(F.lit(rel).alias("rel"), F.col(a).cast("string").alias("src"), F.col(b).cast("string").alias("dst"))
    return (
        edge(docs(spark, sf, "municipality_id").filter("municipality_id is not null"), "HAS_DOCUMENT", "municipality_id", "document_id")
        .unionByName(edge(segments(spark, sf, "document_id"), "HAS_SEGMENT", "document_id", "segment_id"))
        .unionByName(edge(chunks(spark, sf, "segment_id", where="segment_id is not null"), "HAS_CHUNK", "segment_id", "chunk_id"))
    )


@query("gr_segment_meta", f"WITH {SEG_SQL}, {CHUNK_SQL} SELECT c.chunk_id, s.impact_score, s.heading_context FROM ch c LEFT JOIN seg s ON c.segment_id = s.segment_id")
def gr_segment_meta(spark, sf):
    s = segments(spark, sf, "impact_score", "heading_context")
    return chunks(spark, sf, "segment_id").join(s, "segment_id", "left").select("chunk_id", "impact_score", "heading_context")


@query("gr_project", "WITH b AS (SELECT l_suppkey AS src, l_partkey + 1000000000 AS dst FROM lineitem) SELECT src, dst, count(*) AS weight FROM (SELECT src, dst FROM b UNION ALL SELECT dst, src FROM b) GROUP BY ALL")
def gr_project(spark, sf):
    e = supply(spark, sf).withColumn("dst", F.col("dst") + 1000000000)
    return graph.undirected(e)


@query("agg_mentions", "SELECT l_orderkey AS segment, l_partkey AS entity, count(*) AS weight FROM lineitem GROUP BY ALL")
def agg_mentions(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("segment"), F.col("l_partkey").alias("entity")).agg(F.count("*").alias("weight"))


@query("agg_entity_mentions_top", "SELECT l_partkey AS entity, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, entity LIMIT 10")
def agg_entity_mentions_top(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("entity")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entity").limit(10)


@query("agg_edge_upsert", "SELECT l_suppkey AS src, l_partkey AS dst, min(l_orderkey) AS first_evidence, count(*) AS n FROM lineitem GROUP BY ALL")
def agg_edge_upsert(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")).agg(F.min("l_orderkey").alias("first_evidence"), F.count("*").alias("n"))


@query("agg_entity_upsert", """WITH e AS (SELECT DISTINCT * FROM entity_canonical) SELECT normalised_key, min_by(canonical_name, entity_id) FILTER (canonical_name IS NOT NULL) AS canonical_name,
 min_by(category, entity_id) AS category, CAST(sum(frequency) AS BIGINT) AS frequency FROM e GROUP BY 1""")
def agg_entity_upsert(spark, sf):
    """First known attribute of each entity key."""
    e = table(spark, sf, "entity_canonical").distinct()
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("entity_id")))
    return e.groupBy("normalised_key").agg(first("canonical_name").alias("canonical_name"), F.min_by("category", "entity_id").alias("category"), F.sum("frequency").alias("frequency"))


@query("join_rel_endpoints", """SELECT l.l_orderkey, l.l_linenumber, coalesce('Akteur::' || s.s_name, 'Dokument::Sonstiges::' || l.l_suppkey) AS source_key, coalesce('Infrastruktur::' || p.p_name, 'Dokument::Sonstiges::' || l.l_partkey) AS target_key
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey AND s.s_acctbal > 0 LEFT JOIN part p ON l.l_partkey = p.p_partkey AND p.p_size > 5""")
def join_rel_endpoints(spark, sf):
    """Keys of both ends of each relation, with a fallback where an end isn't known."""
    s = table(spark, sf, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    p = table(spark, sf, "part").filter("p_size > 5").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")  # noqa: E741
    key = lambda kind, name, k: F.coalesce(F.concat(F.lit(f"{kind}::"), name), F.concat(F.lit("Dokument::Sonstiges::"), k))
    return l.join(s, "l_suppkey", "left").join(p, "l_partkey", "left").select("l_orderkey", "l_linenumber", key("Akteur", "s_name", "l_suppkey").alias("source_key"), key("Infrastruktur", "p_name", "l_partkey").alias("target_key"))


MEMBER_SQL = "m AS (SELECT s_suppkey AS node, s_nationkey AS community FROM supplier)"


def members(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("community"))


@query("agg_community_size", f"WITH {MEMBER_SQL} SELECT community, count(*) AS n FROM m GROUP BY 1 HAVING count(*) >= 3")
def agg_community_size(spark, sf):
    return members(spark, sf).groupBy("community").agg(F.count("*").alias("n")).filter("n >= 3")


COPART_SQL = "o AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem), c AS (SELECT a.l_suppkey AS src, b.l_suppkey AS dst, count(*) AS weight FROM o a JOIN o b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY ALL)"


def together(spark, sf):
    """Suppliers that deliver to the same order; an order has few lines."""
    o = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    a, b = o.select("l_orderkey", F.col("l_suppkey").alias("src")), o.select("l_orderkey", F.col("l_suppkey").alias("dst"))
    return a.join(b, "l_orderkey").filter("src < dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))


@query("join_community_internal", f"WITH {MEMBER_SQL}, {COPART_SQL} SELECT m1.community, count(*) AS n_edges, CAST(sum(weight) AS BIGINT) AS weight FROM c JOIN m m1 ON c.src = m1.node JOIN m m2 ON c.dst = m2.node AND m1.community = m2.community GROUP BY 1")
def join_community_internal(spark, sf):
    m = members(spark, sf)
    a, b = m.select(F.col("node").alias("src"), "community"), m.select(F.col("node").alias("dst"), F.col("community").alias("other"))
    return together(spark, sf).join(a, "src").join(b, "dst").filter("community = other").groupBy("community").agg(F.count("*").alias("n_edges"), F.sum("weight").alias("weight"))


@query("join_community_segments", f"""WITH {MEMBER_SQL} SELECT community, l_orderkey, rank FROM (SELECT community, l_orderkey, row_number() OVER (PARTITION BY community ORDER BY price DESC, l_orderkey) AS rank
 FROM (SELECT community, l_orderkey, max(l_extendedprice) AS price FROM lineitem JOIN m ON l_suppkey = node GROUP BY ALL)) WHERE rank <= 5""")
def join_community_segments(spark, sf):
    """Five best passages of each community."""
    from pyspark.sql import Window

    l = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("node"), "l_orderkey", "l_extendedprice").join(members(spark, sf), "node")  # noqa: E741
    best = l.groupBy("community", "l_orderkey").agg(F.max("l_extendedprice").alias("price"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("community").orderBy(F.desc("price"), "l_orderkey"))).filter("rank <= 5").select("community", "l_orderkey", "rank")


@query("join_entity_neighborhood", f"""WITH {EDGE_SQL}, b AS (SELECT src AS node, dst AS other, weight FROM e UNION ALL SELECT dst, src, weight FROM e WHERE dst IN (SELECT s_suppkey FROM supplier))
SELECT node, other, weight, rank FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, other) AS rank FROM b) WHERE rank <= 40""")
def join_entity_neighborhood(spark, sf):
    """The forty strongest neighbours of every supplier's key."""
    nodes = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"))
    return graph.neighbourhood(supply(spark, sf), nodes, 40).select("node", "other", "weight", "rank")


@query("gr_transitive_admin", """WITH RECURSIVE up AS (SELECT 'c' || c_custkey AS node, 'n' || c_nationkey AS parent FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
t AS (SELECT node, parent AS ancestor FROM up UNION SELECT t.node, up.parent FROM t JOIN up ON t.ancestor = up.node) SELECT node, ancestor FROM t""")
def gr_transitive_admin(spark, sf):
    """All units in which a place lies, by following containment."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    up = c.select(F.concat(F.lit("c"), "c_custkey").alias("node"), F.concat(F.lit("n"), "c_nationkey").alias("parent")).unionByName(n.select(F.concat(F.lit("n"), "n_nationkey").alias("node"), F.concat(F.lit("r"), "n_regionkey").alias("parent")))
    return graph.ancestors(up)


@query("gr_frontier_bfs", f"""WITH {EDGE_SQL}, u AS (SELECT 's' || src AS a, 'p' || dst AS b FROM e), g AS (SELECT a, b FROM u UNION ALL SELECT b, a FROM u), h1 AS (SELECT DISTINCT b AS node FROM g WHERE a = 's1'),
h2 AS (SELECT DISTINCT g.b AS node FROM g JOIN h1 ON g.a = h1.node WHERE g.b <> 's1' AND g.b NOT IN (SELECT node FROM h1)) SELECT 's1' AS node, 0 AS depth UNION ALL SELECT node, 1 FROM h1 UNION ALL SELECT node, 2 FROM h2""")
def gr_frontier_bfs(spark, sf):
    """Nodes within two steps of a seed."""
    e = supply(spark, sf).select(F.concat(F.lit("s"), "src").alias("a"), F.concat(F.lit("p"), "dst").alias("b"))
    both = e.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(e.select(F.col("b").alias("src"), F.col("a").alias("dst")))
    return graph.within_hops(both, spark.createDataFrame([("s1",)], "node string"), 2)


@query("gr_frontier_best_first")
def gr_frontier_best_first(spark, sf):
    """Forty nodes of each region in the order of a best-first traversal of its suppliers' parts, eight workers at a time."""
    e = supply(spark, sf).join(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("src"), F.col("s_nationkey").alias("site")), "src")
    a, b = F.concat(F.lit("s"), "src"), F.concat(F.lit("p"), "dst")
    both = e.select("site", a.alias("src"), b.alias("dst"), F.col("weight").alias("priority")).unionByName(e.select("site", b.alias("src"), a.alias("dst"), F.col("weight").alias("priority")))
    seeds = e.groupBy("site").agg(F.min("src").alias("first")).select("site", F.concat(F.lit("s"), "first").alias("node"), F.lit(1).cast("long").alias("priority"))
    return graph.best_first(both, seeds, max_depth=6, budget=40, batch=8)


@query("gr_community")
def gr_community(spark, sf):
    """Communities of suppliers that deliver to the same orders."""
    return graph.communities(together(spark, sf))


@query("gr_belongs", f"WITH {COPART_SQL} SELECT count(DISTINCT node) AS nodes, true AS each_once, true AS better_than_apart FROM (SELECT src AS node FROM c UNION ALL SELECT dst FROM c)")
def gr_belongs(spark, sf):
    """What holds of any communities: every node is in one, and they are at least as modular as nodes apart."""
    e = stage_table(together(spark, sf), "together")
    m = stage_table(graph.communities(e), "members")
    apart = m.select("node", F.col("node").alias("community"))
    found, least = graph.modularity(e, m), graph.modularity(e, apart).withColumnRenamed("modularity", "least")
    return m.agg(F.countDistinct("node").alias("nodes"), (F.count("*") == F.countDistinct("node")).alias("each_once")).crossJoin(found).crossJoin(least).select("nodes", "each_once", (F.col("modularity") >= F.col("least")).alias("better_than_apart"))


@query("udf_llm_report_found")
def udf_llm_report_found(spark, sf):
    """Reports of the communities found, of three members or more."""
    from ..models import offline

    m = stage_table(graph.communities(together(spark, sf)), "members")
    big = m.groupBy("community").agg(F.count("*").alias("size")).filter("size >= 3")
    return offline.reports(m.join(big, "community").select("node", "community"))


@query("gr_community_context", f"""WITH {MEMBER_SQL}, {COPART_SQL}, n AS (SELECT community, s_name AS name FROM m JOIN supplier ON s_suppkey = node), a AS (SELECT community, array_to_string(list(name ORDER BY name), ', ') AS entities FROM (SELECT *, row_number() OVER (PARTITION BY community ORDER BY name) AS r FROM n) WHERE r <= 20 GROUP BY 1),
i AS (SELECT m1.community, src, dst, weight, row_number() OVER (PARTITION BY m1.community ORDER BY weight DESC, src, dst) AS r FROM c JOIN m m1 ON c.src = m1.node JOIN m m2 ON c.dst = m2.node AND m1.community = m2.community),
b AS (SELECT community, array_to_string(list(src || ' -- ' || dst ORDER BY r), '; ') AS relations FROM i WHERE r <= 30 GROUP BY 1),
s AS (SELECT community, l_orderkey, row_number() OVER (PARTITION BY community ORDER BY price DESC, l_orderkey) AS r FROM (SELECT community, l_orderkey, max(l_extendedprice) AS price FROM lineitem JOIN m ON l_suppkey = node GROUP BY ALL)),
d AS (SELECT community, array_to_string(list(substring('Auftrag ' || l_orderkey, 1, 400) ORDER BY r), chr(10)) AS snippets FROM s WHERE r <= 5 GROUP BY 1)
SELECT a.community, entities, coalesce(relations, '') AS relations, coalesce(snippets, '') AS snippets FROM a LEFT JOIN b USING (community) LEFT JOIN d USING (community)""")
def gr_community_context(spark, sf):
    """What a report of a community is written from: twenty names, thirty relations inside, five passages."""
    from pyspark.sql import Window

    m = stage_table(members(spark, sf), "members")
    ordered = lambda c, by: F.transform(F.sort_array(F.collect_list(F.struct(by, c))), lambda x: x[c])
    best = lambda df, n, *by: df.withColumn("r", F.row_number().over(Window.partitionBy("community").orderBy(*by))).filter(F.col("r") <= n).groupBy("community")
    names = m.join(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_name").alias("name")), "node")
    entities = best(names, 20, "name").agg(F.array_join(ordered("name", "r"), ", ").alias("entities"))
    a, b = m.select(F.col("node").alias("src"), "community"), m.select(F.col("node").alias("dst"), F.col("community").alias("other"))
    inside = together(spark, sf).join(a, "src").join(b, "dst").filter("community = other").withColumn("pair", F.concat_ws(" -- ", "src", "dst"))
    relations = best(inside, 30, F.desc("weight"), "src", "dst").agg(F.array_join(ordered("pair", "r"), "; ").alias("relations"))
    passages = join_community_segments(spark, sf).withColumn("text", F.substring(F.concat(F.lit("Auftrag "), "l_orderkey"), 1, 400))
    snippets = passages.groupBy("community").agg(F.array_join(ordered("text", "rank"), "\n").alias("snippets"))
    found = entities.join(relations, "community", "left").join(snippets, "community", "left")
    return found.select("community", "entities", F.coalesce("relations", F.lit("")).alias("relations"), F.coalesce("snippets", F.lit("")).alias("snippets"))
