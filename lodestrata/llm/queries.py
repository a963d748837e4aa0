"""Queries over the operators of a training-data pipeline, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import bpe, main_body, name_variants, near_dup, nn_descent, packing, pieces, reading, scan_repair, site_lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


@query("p8_ids")
def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_corpus(docs, "doc_id", "text")


@query("p10_found")
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading level of each document of at least 800 characters."""
    docs = table(spark, sf_dir, "documents").filter("n_chars >= 800").select("doc_id", "text")
    graded = reading.reading_levels(docs, table(spark, sf_dir, "reading_labels"))
    return graded.filter("level is not null").select("doc_id", "level")


@query("p10_profile")
def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and mean estimates of each language and level."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    graded = reading.reading_levels(docs, table(spark, sf_dir, "reading_labels"))
    return graded.groupBy("language", "level").agg(F.count("*").alias("n_docs"), *[F.round(F.avg(f), 3).alias(f"avg_{f}") for f in reading.FORMULAS])


def _web_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    web = table(spark, sf_dir, "segments").filter("page_ref is null").select("segment_id", "document_id", "municipality_id", "text")
    return site_lines.repeated_lines(web, "segment_id", "document_id", "municipality_id", "text", min_docs=6)


_P3_SQL = r"""
WITH l AS (
  SELECT DISTINCT segment_id, document_id, municipality_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no,
         unnest(string_split(text, chr(10))) AS line
  FROM segments WHERE page_ref IS NULL AND municipality_id IS NOT NULL),
n AS (
  SELECT segment_id, document_id, municipality_id, line_no,
         regexp_replace(trim(regexp_replace(lower(line), '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')), '\p{Nd}+', '#', 'g') AS k FROM l),
f AS (SELECT municipality_id, k FROM n WHERE k <> '' GROUP BY 1, 2 HAVING count(DISTINCT document_id) >= 6)
SELECT DISTINCT segment_id, CAST(line_no AS INTEGER) AS line_no FROM n JOIN f USING (municipality_id, k)
""".replace("\\\\", "\\")


@query("p3_found", _P3_SQL)
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in verified clusters of at least six documents whose own form stands in as many: the exact count within the cluster."""
    return _web_lines(spark, sf_dir).filter("line_docs >= 6").select("segment_id", "line_no").distinct()


@query("p3_clusters")
def p3_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cluster of near-duplicate repeated lines with its documents and places."""
    return _web_lines(spark, sf_dir).groupBy("municipality_id", "cluster").agg(F.max("cluster_docs").alias("n_docs"), F.count("*").alias("n_places"))


@query("p3_clean")
def p3_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of web segments without the lines repeated in their municipality."""
    web = table(spark, sf_dir, "segments").filter("page_ref is null")
    return site_lines.without_lines(web, "segment_id", "text", _web_lines(spark, sf_dir))


def _alike(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    web = table(spark, sf_dir, "segments").filter("page_ref is null").select("segment_id", "document_id", "text")
    return near_dup.near_duplicates(web, "segment_id", "document_id", "text", k=3, threshold=0.6, min_chars=200)


@query("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of web segments of different documents that share at least 0.6 of their three-word sequences."""
    return near_dup.item_pairs(*_alike(spark, sf_dir)).select(F.col("a").alias("segment_id_a"), F.col("b").alias("segment_id_b"))


@query("p1_groups")
def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each web segment of 200 characters or more with its class of equal texts, its links and its group."""
    return near_dup.group_labels(*_alike(spark, sf_dir)).withColumnRenamed("item", "segment_id")


@query("p2_found")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of chunks of which one is among the other's five most similar, with a cosine of at least 0.85."""
    near = nn_descent.nearest(table(spark, sf_dir, "chunks"), "chunk_id", "embedding", dim=64, k=5)
    pairs = near.filter("similarity >= 0.85")
    return pairs.select(F.least("chunk_id", "neighbour").alias("chunk_id_a"), F.greatest("chunk_id", "neighbour").alias("chunk_id_b")).distinct()


@query("p2_nearest")
def p2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most similar chunks of every usable chunk."""
    near = nn_descent.nearest(table(spark, sf_dir, "chunks"), "chunk_id", "embedding", dim=64, k=5)
    return near.withColumn("similarity", F.round("similarity", 3))


@query("p2_search")
def p2_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy graph search: the five best chunks for every vector of ``embeddings`` whose id is divisible by 20."""
    vectors = nn_descent.stage_table(nn_descent.unit_vectors(table(spark, sf_dir, "chunks"), "chunk_id", "embedding", 64), "vectors")
    graph = nn_descent.neighbour_graph(vectors, 64)
    asked = table(spark, sf_dir, "embeddings").filter("vec_id % 20 = 0").select(F.col("vec_id").cast("string").alias("k"), "embedding")
    asked = nn_descent.unit_vectors(asked, "k", "embedding", 64).select(F.col("key").cast("long").alias("qid"), "q")
    found = nn_descent.search(graph, vectors, asked, 64)
    return found.join(vectors.select("id", F.col("key").alias("chunk_id")), "id").select(F.col("qid").alias("vec_id"), "chunk_id", F.round("similarity", 3).alias("similarity"))


def _main_scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Segments of web pages, and (item, doc, main) of those of HTML documents."""
    raw = table(spark, sf_dir, "documents_raw")
    html = F.lower("content_type").contains("html") | (F.col("content_type").isNull() & (F.col("raw_ext") == ".html"))
    docs = raw.filter(html).select(F.col("document_id").alias("doc")).distinct()
    seg = table(spark, sf_dir, "segments").filter("page_ref is null").select(
        F.col("segment_id").alias("item"), F.col("document_id").alias("doc"), F.col("municipality_id").alias("host"), F.col("order_index").alias("ord"),
        F.col("segment_type").alias("kind"), "text", F.col("heading_context").isNull().cast("int").alias("no_context"),
    )
    labels = table(spark, sf_dir, "segment_labels").select(F.col("segment_id").alias("item"), F.col("is_main").alias("label"))
    return seg, main_body.main_scores(seg, labels).join(docs, "doc", "left_semi")


@query("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of HTML documents without a line of the main body."""
    return _main_scores(spark, sf_dir)[1].filter("main < 0.5").select(F.col("item").alias("segment_id"))


@query("p4_body")
def p4_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main body of each HTML document: its main segments in order, without their lines that repeat on other pages."""
    seg, scores = _main_scores(spark, sf_dir)
    kept = seg.select("doc", "ord", "item", "text").join(scores.filter("main >= 0.5").select("item", "frame_lines"), "item")
    unique = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("frame_lines", i)), "\n")
    kept = kept.withColumn("text", F.when(F.size("frame_lines") > 0, unique).otherwise(F.col("text")))
    parts = kept.groupBy("doc").agg(F.sort_array(F.collect_set(F.struct("ord", "item", "text"))).alias("s"))
    return parts.select(F.col("doc").alias("document_id"), F.size("s").alias("n_segments"), F.array_join(F.transform("s", lambda x: x["text"]), "\n").alias("main_text"))


def _long_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, item, text, overlap) of the oversized segments and chunks, once each."""
    seg = pieces.oversized(table(spark, sf_dir, "segments").select("segment_id", "text"), "segment_id", "text").dropDuplicates(["segment_id"])
    chunk = table(spark, sf_dir, "chunks").select("chunk_id", "segment_id", "chunk_index", "text", "overlap")
    first = chunk.filter("segment_id is not null").groupBy("segment_id").agg(F.min_by("overlap", F.struct("chunk_index", "chunk_id")).alias("overlap"))
    long_chunk = pieces.oversized(chunk, "chunk_id", "text").dropDuplicates(["chunk_id"])
    s = seg.join(first, "segment_id", "left").select(F.lit("segment").alias("item_kind"), F.col("segment_id").alias("item_id"), "text", "overlap")
    return s.unionByName(long_chunk.select(F.lit("chunk").alias("item_kind"), F.col("chunk_id").alias("item_id"), "text", "overlap"))


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _long_texts(spark, sf_dir).withColumn("key", F.concat_ws(":", "item_kind", "item_id"))
    cut = pieces.split_texts(texts, "key", "text", "overlap")
    return cut.select(F.substring_index("item", ":", 1).alias("item_kind"), F.expr("substring(item, instr(item, ':') + 1)").alias("item_id"), "piece_no", "start", "shared", "stop", "piece")


@query("p5_found", """
SELECT DISTINCT 'segment' AS item_kind, segment_id AS item_id FROM segments WHERE length(trim(text, ' ')) > 2000
UNION SELECT DISTINCT 'chunk', chunk_id FROM chunks WHERE length(trim(text, ' ')) > 2000
""")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that were split, from the pieces themselves."""
    return _pieces(spark, sf_dir).filter("piece_no > 0").select("item_kind", "item_id").distinct()


@query("p5_pieces")
def p5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every oversized segment and chunk."""
    return _pieces(spark, sf_dir)


def _pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    seg = table(spark, sf_dir, "segments").filter("text is not null")
    pages = seg.filter("page_ref is not null").select(F.col("segment_id").alias("item"), F.col("document_id").alias("doc"), F.col("order_index").alias("ord"), "text").dropDuplicates(["item"])
    return pages, seg.filter("page_ref is null").select("text")


@query("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of pages that are furniture, end in a broken word, or have a misread character."""
    rows, fixes = scan_repair.repair(*_pages(spark, sf_dir))
    return scan_repair.marked_lines(rows, fixes).select(F.col("item").alias("segment_id"), "line_no", "kind")


@query("p6_text")
def p6_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scanned or printed document as continuous paragraphs."""
    pages, clean = _pages(spark, sf_dir)
    rows, fixes = scan_repair.repair(pages, clean)
    return scan_repair.paragraphs(pages, rows, fixes).select(F.col("doc").cast("long").alias("document_id"), "text")


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_variants.resolve(table(spark, sf_dir, "entity_canonical"), "entity_id", "original_name", "entity_type")


@query("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of rows that name the same entity."""
    g = name_variants.stage_table(_named(spark, sf_dir).select("entity_id", "group"), "groups")
    a, b = g.withColumnRenamed("entity_id", "entity_id_a"), g.withColumnRenamed("entity_id", "entity_id_b")
    return a.join(b, "group").filter("entity_id_a < entity_id_b").select("entity_id_a", "entity_id_b")


@query("p7_groups")
def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of every row with a name, and the rows of the group."""
    g = name_variants.stage_table(_named(spark, sf_dir).select("entity_id", "group"), "groups")
    return g.join(g.groupBy("group").agg(F.min("entity_id").alias("first_id"), F.count("*").alias("n_rows")), "group").select("entity_id", "first_id", "n_rows")


@query("p7_canonical")
def p7_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical name of every row."""
    return _named(spark, sf_dir).select("entity_id", "canonical_name")


def _containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("text <> ''").select("doc_id", "text")
    return packing.containers(bpe.token_counts(docs, "doc_id", "text"), "doc_id", "n_tokens", 4096)


@query("p9_containers")
def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container of every document with a text; longer documents are cut into several pieces."""
    return _containers(spark, sf_dir)


@query("p9_fill")
def p9_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers by how full they are, in tenths."""
    per = _containers(spark, sf_dir).groupBy("container").agg(F.sum("tokens").alias("tokens"))
    return per.groupBy(F.floor(F.col("tokens") * 10 / 4096).cast("int").alias("tenths")).agg(F.count("*").alias("n_containers"), F.sum("tokens").alias("tokens"))
