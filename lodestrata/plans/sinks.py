"""Round trips through the sinks, and the store's merge writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge
from ..session import table
from ..sinks import writers
from .catalog import query
from .store import CHUNK_SQL, DOCS_SQL, SEG_SQL, chunks, docs, segments


@query("snk_raw_cas", "SELECT DISTINCT sha256(text) AS raw_hash, octet_length(encode(text)) AS n_bytes FROM documents WHERE text <> ''")
def snk_raw_cas(spark, sf):
    """Texts as files named by their hashes, found again in the folder."""
    return writers.raw_files(table(spark, sf, "documents"), "text")


@query("snk_insert_ignore", f"""WITH {SEG_SQL} SELECT document_id, segment_hash, min_by(segment_id, (order_index, segment_id)) AS segment_id FROM seg GROUP BY ALL""")
def snk_insert_ignore(spark, sf):
    """First segment of each text of a document, inserted in two batches."""
    s = segments(spark, sf, "document_id", "segment_hash", "order_index")
    first = merge.insert_ignore(s.limit(0), s.filter("order_index < 5"), ["document_id", "segment_hash"], ["order_index", "segment_id"])
    return merge.insert_ignore(first, s, ["document_id", "segment_hash"], ["order_index", "segment_id"]).select("document_id", "segment_hash", "segment_id")


@query("snk_upsert", "SELECT url_canonical, max(fetched_at) AS last_fetch_at FROM documents_raw GROUP BY 1")
def snk_upsert(spark, sf):
    """Last fetch of each URL, written in two batches."""
    r = table(spark, sf, "documents_raw").select("url_canonical", F.col("fetched_at").alias("last_fetch_at"))
    early, late = r.filter("second(last_fetch_at) < 30"), r.filter("second(last_fetch_at) >= 30")
    one = merge.upsert(r.limit(0), early, ["url_canonical"], ["last_fetch_at"])
    return merge.upsert(one, late.unionByName(one), ["url_canonical"], ["last_fetch_at"])


@query("snk_replace", "SELECT DISTINCT entity_id, coalesce(canonical_name, original_name) AS canonical_name, CASE WHEN canonical_name IS NULL THEN 2 ELSE 1 END AS run FROM entity_canonical")
def snk_replace(spark, sf):
    """Canonical names of a second run written over those of the first, which left some out."""
    e = table(spark, sf, "entity_canonical")
    first = e.select("entity_id", "canonical_name", F.lit(1).alias("run")).distinct()
    second = e.filter("canonical_name is null").select("entity_id", F.col("original_name").alias("canonical_name"), F.lit(2).alias("run"))
    return writers.parquet(merge.upsert(first, second, ["entity_id"], ["run"]))


@query("snk_update_from", f"""WITH {DOCS_SQL}, t AS (SELECT url_canonical, min(document_id) AS target FROM docs GROUP BY 1) SELECT d.document_id, t.target FROM docs d LEFT JOIN t ON d.url_final = t.url_canonical""")
def snk_update_from(spark, sf):
    d = docs(spark, sf, "url_final", "url_canonical")
    links = d.select("document_id", "url_final", F.lit(None).cast("long").alias("target"))
    return merge.fill_from(links, "target", "url_final", d, "url_canonical", "document_id").select("document_id", "target")


@query("set_delete_missing", f"WITH {SEG_SQL} SELECT segment_id FROM seg WHERE document_id IN (SELECT doc_id FROM documents)")
def set_delete_missing(spark, sf):
    return merge.delete_missing(segments(spark, sf, "document_id"), table(spark, sf, "documents").select(F.col("doc_id").alias("document_id")), ["document_id"]).select("segment_id")


@query("snk_csv", "SELECT ags, name, population FROM municipalities")
def snk_csv(spark, sf):
    return writers.csv(table(spark, sf, "municipalities").select("ags", "name", "population"))


@query("snk_parquet", f"WITH {SEG_SQL} SELECT segment_id, segment_type FROM seg")
def snk_parquet(spark, sf):
    return writers.parquet(segments(spark, sf, "segment_type"))


@query("snk_sqlite_table", "SELECT ags, array_to_string(list_sort(list_distinct(list_filter(string_split(lower(coalesce(allowed_domains, '')), '|'), lambda d: d <> ''))), '|') AS domains FROM municipalities")
def snk_sqlite_table(spark, sf):
    m = table(spark, sf, "municipalities")
    d = F.array_sort(F.array_distinct(F.filter(F.split(F.lower(F.coalesce("allowed_domains", F.lit(""))), r"\|"), lambda x: x != "")))
    return writers.parquet(m.select("ags", F.array_join(d, "|").alias("domains")))


@query("snk_graph", f"""WITH {DOCS_SQL}, {SEG_SQL}, m AS (SELECT DISTINCT ags, name FROM municipalities),
n AS (SELECT 'm' || ags AS id, 'Municipality' AS label, name FROM m UNION SELECT 'd' || document_id, 'Document', NULL FROM docs UNION SELECT 'm' || municipality_id, 'Municipality', NULL FROM docs WHERE municipality_id NOT IN (SELECT ags FROM m)),
e AS (SELECT 'm' || municipality_id AS src, 'd' || document_id AS dst, count(*) AS n FROM documents_raw WHERE municipality_id IS NOT NULL GROUP BY ALL)
SELECT id, label, name, NULL AS dst, CAST(NULL AS BIGINT) AS n FROM n UNION ALL SELECT src, 'HAS_DOCUMENT', NULL, dst, n FROM e""")
def snk_graph(spark, sf):
    """Nodes and edges merged from two loads: a node keeps what it had, an edge counts how often it came."""
    r = table(spark, sf, "documents_raw").filter("municipality_id is not null")
    m = table(spark, sf, "municipalities").select(F.concat(F.lit("m"), "ags").alias("id"), F.lit("Municipality").alias("label"), "name").distinct()
    met = r.select(F.concat(F.lit("m"), "municipality_id").alias("id"), F.lit("Municipality").alias("label"), F.lit(None).cast("string").alias("name"))
    own = table(spark, sf, "documents_raw").select(F.concat(F.lit("d"), "document_id").alias("id"), F.lit("Document").alias("label"), F.lit(None).cast("string").alias("name"))
    nodes = merge.insert_ignore(m, met.unionByName(own).distinct(), ["id"], ["label"])
    edge = lambda df: df.select(F.concat(F.lit("m"), "municipality_id").alias("src"), F.concat(F.lit("d"), "document_id").alias("dst"), F.lit(1).cast("long").alias("n"))
    early, late = r.filter("second(fetched_at) < 30"), r.filter("second(fetched_at) >= 30")
    edges = merge.add_up(merge.add_up(edge(early.limit(0)), edge(early), ["src", "dst"], "n"), edge(late), ["src", "dst"], "n")
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    return writers.parquet(nodes.select("id", "label", "name", none("dst", "string"), none("n", "long"))).unionByName(
        writers.parquet(edges.select(F.col("src").alias("id"), F.lit("HAS_DOCUMENT").alias("label"), none("name", "string"), "dst", "n"))
    )


@query("snk_vectors", f"""SELECT vec_id, CAST({' + '.join(f'CASE WHEN embedding[{i + 1}] > 0 THEN {1 << i} ELSE 0 END' for i in range(6))} AS INTEGER) AS bucket, len(embedding) AS dim,
 round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total FROM embeddings""")
def snk_vectors(spark, sf):
    """Vectors stored by the signs of their first numbers, as an index by which a search reads few folders."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    signs = [F.when(F.get("embedding", F.lit(i)) > 0, 1 << i).otherwise(0) for i in range(6)]
    bucket = signs[0]
    for x in signs[1:]:
        bucket = bucket + x
    stored = writers.parquet(e.withColumn("bucket", bucket.cast("int")), ["bucket"])
    return stored.select("vec_id", "bucket", F.size("embedding").alias("dim"), F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"))


@query("snk_json_report", f"WITH {SEG_SQL} SELECT segment_type, count(*) AS n FROM seg GROUP BY 1")
def snk_json_report(spark, sf):
    return writers.json(segments(spark, sf, "segment_type").groupBy("segment_type").agg(F.count("*").alias("n")))


@query("snk_markdown", "SELECT '| ' || r_regionkey || ' | ' || r_name || ' |' AS line FROM region")
def snk_markdown(spark, sf):
    lines = writers.markdown(table(spark, sf, "region").select("r_regionkey", "r_name")).split("\n")[2:]
    return spark.createDataFrame([(x,) for x in lines], "line string")


@query("snk_shards", "WITH m AS (SELECT ags, row_number() OVER (ORDER BY ags) AS rn, count(*) OVER () AS n FROM municipalities) SELECT CAST(least((rn - 1) // (n // 20), 19) AS INTEGER) AS shard, count(*) AS n_rows FROM m GROUP BY 1")
def snk_shards(spark, sf):
    from ..operators import passages

    s = passages.range_shards(table(spark, sf, "municipalities").select("ags"), "ags", 20)
    return writers.parquet(s.withColumn("shard", F.col("shard").cast("int")), ["shard"]).groupBy("shard").agg(F.count("*").alias("n_rows"))


@query("snk_terminal", f"WITH {SEG_SQL} SELECT segment_id, regexp_replace(substring(text, 1, 300), '([0-9]+ Euro)', '[\\1]', 'g') AS preview FROM seg WHERE contains(text, ' Euro') ORDER BY impact_score DESC NULLS LAST, segment_id LIMIT 15")
def snk_terminal(spark, sf):
    """Preview of the best amounts, marked."""
    s = segments(spark, sf, "impact_score", F.substring("text", 1, 300).alias("t"), where=F.col("text").contains(" Euro"))
    s = s.orderBy(F.desc_nulls_last("impact_score"), "segment_id").limit(15)
    return writers.highlighted(s, "t", "[0-9]+ Euro").select("segment_id", "preview")


@query("src_triplets", f"WITH {CHUNK_SQL} SELECT chunk_id, to_json({{'entities': [heading_context], 'score': impact_score}}) AS graph_json FROM ch WHERE heading_context IS NOT NULL AND impact_score IS NOT NULL")
def src_triplets(spark, sf):
    c = chunks(spark, sf, "heading_context", "impact_score", where="heading_context is not null and impact_score is not null")
    return c.select("chunk_id", F.to_json(F.struct(F.array("heading_context").alias("entities"), F.col("impact_score").alias("score"))).alias("graph_json"))


@query("src_entity_explode", f"WITH {CHUNK_SQL}, e AS (SELECT chunk_id, unnest(string_split(heading_context, ' ')) AS name FROM ch WHERE heading_context IS NOT NULL) SELECT trim(name) AS name, count(*) AS n FROM e WHERE length(trim(name)) >= 2 GROUP BY 1")
def src_entity_explode(spark, sf):
    """Names out of stored JSON, bad JSON and short names skipped."""
    c = chunks(spark, sf, "heading_context", where="heading_context is not null").select(F.to_json(F.struct(F.split("heading_context", " ", -1).alias("entities"))).alias("j"))
    e = c.select(F.explode(F.from_json("j", "entities array<string>").getField("entities")).alias("name")).select(F.trim("name").alias("name")).filter(F.char_length("name") >= 2)
    return e.groupBy("name").agg(F.count("*").alias("n"))


@query("src_seed_csv", "SELECT ags, homepage_url FROM (SELECT ags, homepage_url, row_number() OVER (ORDER BY ags) AS rn FROM municipalities) WHERE rn BETWEEN 11 AND 40")
def src_seed_csv(spark, sf):
    """A slice of a seed file."""
    from ..operators import passages

    seeds = writers.csv(table(spark, sf, "municipalities").select("ags", "homepage_url"))
    return passages.numbered(seeds, "ags").filter("rn between 11 and 40").select("ags", "homepage_url")
