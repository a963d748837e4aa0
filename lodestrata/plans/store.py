"""Queries over the stored tables: sources, filters, projections, joins, aggregates, windows and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicon, text, urls
from ..operators import joins, merge, passages
from ..session import table
from ..sources import pdf
from .catalog import query

# One row for each document: what its last fetch gave.
DOCS_SQL = """docs AS (SELECT document_id, municipality_id, url_canonical, url_final, content_type, raw_hash, raw_ext, status_code, content_length,
 min(fetched_at) OVER (PARTITION BY document_id) AS first_fetch, max(fetched_at) OVER (PARTITION BY document_id) AS last_fetch
 FROM documents_raw QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY fetched_at DESC NULLS LAST) = 1)"""
SEG_SQL = "seg AS (SELECT DISTINCT * FROM segments)"
CHUNK_SQL = "ch AS (SELECT DISTINCT chunk_id, document_id, municipality_id, segment_id, chunk_index, chunk_hash, text, start_token, end_token, token_count, heading_context, impact_score, embedded_at FROM chunks)"


def docs(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """One row for each document: ``columns`` of its last fetch; ``first_fetch`` and ``last_fetch`` may be among them."""
    own = [c for c in columns if c not in ("first_fetch", "last_fetch")]
    last = F.max_by(F.struct(*own), F.struct("fetched_at", *own)) if own else F.lit(None)
    raw = table(spark, sf, "documents_raw").select("document_id", "fetched_at", *own)
    one = raw.groupBy("document_id").agg(last.alias("last"), F.min("fetched_at").alias("first_fetch"), F.max("fetched_at").alias("last_fetch"))
    return one.select("document_id", *[F.col("last")[c].alias(c) if c in own else F.col(c) for c in columns])


def segments(spark: SparkSession, sf: str, *columns: str | Column, where: str | Column | None = None) -> DataFrame:
    """``segment_id`` and ``columns`` of each segment that meets a condition, once.

    Repeated rows are exact copies; so conditions and columns come first, reach
    the scan, and only what is asked for is shuffled.
    """
    return _once(table(spark, sf, "segments"), "segment_id", columns, where)


def chunks(spark: SparkSession, sf: str, *columns: str | Column, where: str | Column | None = None) -> DataFrame:
    """``chunk_id`` and ``columns`` of each chunk that meets a condition, once."""
    return _once(table(spark, sf, "chunks"), "chunk_id", columns, where)


def _once(t: DataFrame, key: str, columns: tuple[str | Column, ...], where: str | Column | None) -> DataFrame:
    return (t if where is None else t.filter(where)).select(key, *columns).distinct()


# --- sources


@query("src_sqlite_table", "SELECT segment_id, document_id, segment_type, impact_score FROM segments")
def src_table(spark, sf):
    return table(spark, sf, "segments").select("segment_id", "document_id", "segment_type", "impact_score")


@query("src_registry", """
SELECT ags, name, trim(homepage_url) AS homepage_url FROM municipalities
WHERE homepage_url IS NOT NULL AND trim(homepage_url) <> '' AND regexp_matches(trim(homepage_url), '^[hH][tT][tT][pP][sS]?://[^/?#:@]+')
ORDER BY ags LIMIT 50 OFFSET 10""")
def src_registry(spark, sf):
    """A page of the registry: usable homepages in order of their keys."""
    url = F.trim("homepage_url")
    return table(spark, sf, "municipalities").filter(urls.valid(url)).select("ags", "name", url.alias("homepage_url")).orderBy("ags").offset(10).limit(50)


@query("src_unembedded", f"""WITH {CHUNK_SQL}
SELECT chunk_id, impact_score FROM ch WHERE embedded_at IS NULL ORDER BY impact_score DESC NULLS LAST, chunk_id LIMIT 500""")
def src_unembedded(spark, sf):
    """Chunks without a vector, the best first."""
    return chunks(spark, sf, "impact_score", where="embedded_at is null").orderBy(F.desc_nulls_last("impact_score"), "chunk_id").limit(500)


@query("src_pdf", f"""WITH {SEG_SQL} SELECT document_id, page_no, text FROM (SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY order_index, segment_id) AS page_no, trim(text) AS text
 FROM seg WHERE page_ref IS NOT NULL AND text IS NOT NULL) WHERE text <> ''""")
def src_pdf(spark, sf):
    """Pages read back from files of extracted text, a form feed after each page."""
    p = segments(spark, sf, "document_id", "order_index", "text", where="page_ref is not null and text is not null")
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("order_index", "segment_id", "text"))), lambda x: x["text"]), "\f")
    files = p.groupBy("document_id").agg(body.cast("binary").alias("body"))
    return pdf.pages(files, "document_id", "body", pdf.stored_text)


@query("src_meta_json", "SELECT DISTINCT document_id, json_extract_string(meta_json, '$.title') AS title FROM documents_raw WHERE meta_json IS NOT NULL")
def src_meta_json(spark, sf):
    """Titles from the stored metadata."""
    raw = table(spark, sf, "documents_raw").filter("meta_json is not null")
    return raw.select("document_id", F.get_json_object("meta_json", "$.title").alias("title")).distinct()


# --- filters and projections


@query("flt_len_score_neg", f"""WITH {SEG_SQL}
SELECT segment_id FROM seg WHERE length(text) >= 150 AND coalesce(is_negative, 0) = 0 AND coalesce(impact_score, 0) >= 15""")
def flt_len_score_neg(spark, sf):
    return segments(spark, sf, where=passages.good(150, 15))


def _like_sql(parts):
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return "(" + " OR ".join(f"contains({low}, '{p}')" for p in parts) + ")"


@query("flt_like_any", f"WITH {SEG_SQL} SELECT segment_id FROM seg WHERE {_like_sql(lexicon.MONEY)} AND {_like_sql(lexicon.FUNDERS)} AND {_like_sql(lexicon.TOPICS)}")
def flt_like_any(spark, sf):
    """Texts that name an amount, a funder and a topic."""
    t = F.col("text")
    return segments(spark, sf, where=text.like_any(t, lexicon.MONEY) & text.like_any(t, lexicon.FUNDERS) & text.like_any(t, lexicon.TOPICS))


@query("flt_regex_hit", f"WITH {SEG_SQL} SELECT segment_id FROM seg WHERE regexp_matches(text, '{lexicon.re2(lexicon.POSITIVE)}')")
def flt_regex_hit(spark, sf):
    return segments(spark, sf, where=F.col("text").rlike(lexicon.java(lexicon.POSITIVE)))


@query("flt_not_null", f"WITH {CHUNK_SQL} SELECT chunk_id FROM ch WHERE embedded_at IS NOT NULL AND segment_id IS NOT NULL")
def flt_not_null(spark, sf):
    return chunks(spark, sf, where="embedded_at is not null and segment_id is not null")


@query("flt_not_in", f"WITH {SEG_SQL} SELECT segment_id FROM seg WHERE segment_id NOT IN (SELECT segment_id FROM chunks WHERE segment_id IS NOT NULL)")
def flt_not_in(spark, sf):
    done = table(spark, sf, "chunks").filter("segment_id is not null").select("segment_id")
    return segments(spark, sf).join(done, "segment_id", "left_anti")


@query("flt_between", f"WITH {SEG_SQL} SELECT segment_id FROM seg WHERE order_index BETWEEN 3 AND 7 AND page_ref IS NULL")
def flt_between(spark, sf):
    return segments(spark, sf, where=F.col("order_index").between(3, 7) & F.col("page_ref").isNull())


@query("flt_url_valid", f"WITH {DOCS_SQL} SELECT document_id FROM docs WHERE regexp_matches(url_canonical, '^[hH][tT][tT][pP][sS]?://([^/?#@]*@)?[^/?#:@]+')")
def flt_url_valid(spark, sf):
    return docs(spark, sf, "url_canonical").filter(urls.valid(F.col("url_canonical"))).select("document_id")


_HOST_SQL = "lower(regexp_extract(url_canonical, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)', 2))"


@query("flt_allowed_domain", f"""WITH {DOCS_SQL}
SELECT d.document_id FROM docs d JOIN (SELECT DISTINCT ags, allowed_domains FROM municipalities) m ON d.municipality_id = m.ags
WHERE list_contains(string_split(lower(coalesce(allowed_domains, '')), '|'), {_HOST_SQL})""")
def flt_allowed_domain(spark, sf):
    """Documents whose host is on their municipality's list."""
    m = table(spark, sf, "municipalities").select(F.col("ags").alias("municipality_id"), F.split(F.lower(F.coalesce("allowed_domains", F.lit(""))), r"\|").alias("allowed")).distinct()
    return docs(spark, sf, "municipality_id", "url_canonical").join(m, "municipality_id").filter(F.array_contains("allowed", urls.host(F.col("url_canonical")))).select("document_id")


@query("flt_allowed_suffix", f"""WITH {DOCS_SQL}
SELECT d.document_id FROM docs d JOIN (SELECT DISTINCT ags, allowed_domains FROM municipalities) m ON d.municipality_id = m.ags
WHERE len(list_filter(string_split(lower(coalesce(allowed_domains, '')), '|'), lambda x: x <> '' AND ({_HOST_SQL} = x OR ends_with({_HOST_SQL}, '.' || x)))) > 0""")
def flt_allowed_suffix(spark, sf):
    m = table(spark, sf, "municipalities").select(F.col("ags").alias("municipality_id"), F.split(F.lower(F.coalesce("allowed_domains", F.lit(""))), r"\|").alias("allowed")).distinct()
    d = docs(spark, sf, "municipality_id", "url_canonical").join(m, "municipality_id").withColumn("host", urls.host(F.col("url_canonical")))
    return d.filter(F.exists("allowed", lambda x: (x != "") & ((F.col("host") == x) | F.endswith("host", F.concat(F.lit("."), x))))).select("document_id")


_TRAP_SQL = " OR ".join(f"contains(path, '{p}')" for p in lexicon.TRAP_PATHS)


@query("flt_trap", f"""WITH {DOCS_SQL}, u AS (SELECT document_id, coalesce(url_final, url_canonical, '') AS url FROM docs),
p AS (SELECT *, lower(split_part(url, '?', 1)) AS path, lower(CASE WHEN contains(url, '?') THEN substr(url, instr(url, '?') + 1) ELSE '' END) AS query FROM u)
SELECT document_id FROM p WHERE NOT (url = '' OR length(url) > 2048
 OR regexp_extract(path, '\\.([a-z0-9]{{1,6}})$', 1) IN ({', '.join(repr(x) for x in lexicon.TRAP_EXTENSIONS)}) OR {_TRAP_SQL}
 OR (query <> '' AND len(regexp_split_to_array(query, '[&;]')) > 60)
 OR (regexp_matches(url, '(?i)page=|offset=|start=|/page/') AND coalesce(TRY_CAST(regexp_extract(url, '(?i)(?:page=|offset=|start=|/page/)([0-9]{{1,9}})', 1) AS INTEGER), 0) > 20))""")
def flt_trap(spark, sf):
    """Documents whose URL isn't a crawler trap."""
    return docs(spark, sf, "url_final", "url_canonical").filter(~urls.is_trap(F.coalesce("url_final", "url_canonical"), F.lit(0))).select("document_id")


@query("flt_asset_link", f"WITH {DOCS_SQL} SELECT document_id FROM docs WHERE NOT regexp_matches(url_canonical, '(?i)\\.(jpg|jpeg|png|gif|svg|css|js|zip|mp4)(\\?|$)') AND regexp_matches(url_canonical, '^https?:')")
def flt_asset_link(spark, sf):
    u = F.col("url_canonical")
    return docs(spark, sf, "url_canonical").filter(~u.rlike(r"(?i)\.(jpg|jpeg|png|gif|svg|css|js|zip|mp4)(\?|$)") & u.rlike("^https?:")).select("document_id")


@query("flt_block_ext_path", f"WITH {DOCS_SQL} SELECT document_id FROM docs WHERE coalesce(raw_ext, '') NOT IN ('.pdf', '.zip') AND NOT contains(url_canonical, 'beschluss')")
def flt_block_ext_path(spark, sf):
    return docs(spark, sf, "raw_ext", "url_canonical").filter(~F.coalesce("raw_ext", F.lit("")).isin(".pdf", ".zip") & ~F.col("url_canonical").contains("beschluss")).select("document_id")


@query("prj_coalesce_url", f"WITH {DOCS_SQL} SELECT document_id, coalesce(url_final, url_canonical) AS url FROM docs")
def prj_coalesce_url(spark, sf):
    return docs(spark, sf, "url_final", "url_canonical").select("document_id", F.coalesce("url_final", "url_canonical").alias("url"))


@query("prj_truncate", f"WITH {SEG_SQL} SELECT segment_id, substring(text, 1, 400) AS snippet, substring(heading_context, 1, 120) AS heading FROM seg")
def prj_truncate(spark, sf):
    return segments(spark, sf, F.substring("text", 1, 400).alias("snippet"), F.substring("heading_context", 1, 120).alias("heading"))


@query("flt_fetch_gate", f"""WITH {DOCS_SQL} SELECT document_id, CASE WHEN status_code IS NULL OR status_code <> 200 THEN 'http' WHEN raw_hash IS NULL THEN 'empty'
 WHEN content_length > 209715200 THEN 'oversize' WHEN split_part(url_final, '/', 3) <> split_part(url_canonical, '/', 3) THEN 'redirect' ELSE 'ok' END AS reason FROM docs""")
def flt_fetch_gate(spark, sf):
    """Why a fetched document is not read further, or ok."""
    moved = F.split_part("url_final", F.lit("/"), F.lit(3)) != F.split_part("url_canonical", F.lit("/"), F.lit(3))
    reason = F.when(F.col("status_code").isNull() | (F.col("status_code") != 200), "http").when(F.col("raw_hash").isNull(), "empty").when(F.col("content_length") > 209715200, "oversize").when(moved, "redirect").otherwise("ok")
    return docs(spark, sf, "status_code", "raw_hash", "content_length", "url_final", "url_canonical").select("document_id", reason.alias("reason"))


@query("prj_looks_like", f"""WITH {DOCS_SQL} SELECT document_id, CASE WHEN contains(lower(coalesce(content_type, '')), 'pdf') OR ends_with(lower(url_canonical), '.pdf') THEN '.pdf'
 WHEN contains(lower(coalesce(content_type, '')), 'html') OR ends_with(lower(url_canonical), '.html') THEN '.html' ELSE '.bin' END AS kind FROM docs""")
def prj_looks_like(spark, sf):
    t, u = F.lower(F.coalesce("content_type", F.lit(""))), F.lower("url_canonical")
    kind = F.when(t.contains("pdf") | u.endswith(".pdf"), ".pdf").when(t.contains("html") | u.endswith(".html"), ".html").otherwise(".bin")
    return docs(spark, sf, "content_type", "url_canonical").select("document_id", kind.alias("kind"))


# --- joins


@query("join_seg_doc", f"WITH {DOCS_SQL}, {SEG_SQL} SELECT s.segment_id, d.document_id, d.url_canonical FROM seg s JOIN docs d ON s.document_id = d.document_id")
def join_seg_doc(spark, sf):
    return segments(spark, sf, "document_id").join(docs(spark, sf, "url_canonical"), "document_id").select("segment_id", "document_id", "url_canonical")


@query("join_chunk_doc", f"WITH {DOCS_SQL}, {CHUNK_SQL} SELECT c.chunk_id, d.raw_ext FROM ch c JOIN docs d ON c.document_id = d.document_id")
def join_chunk_doc(spark, sf):
    return chunks(spark, sf, "document_id").join(docs(spark, sf, "raw_ext"), "document_id").select("chunk_id", "raw_ext")


@query("anti_processed_segments", f"""WITH {SEG_SQL} SELECT segment_id FROM seg s WHERE length(text) >= 80 AND coalesce(impact_score, 0) >= 10 AND coalesce(is_negative, 0) = 0
 AND NOT EXISTS (SELECT 1 FROM chunks c WHERE c.segment_id = s.segment_id)""")
def anti_processed_segments(spark, sf):
    """Segments worth chunking that have no chunk yet."""
    return joins.not_yet(segments(spark, sf, where=passages.good(80, 10)), table(spark, sf, "chunks"), "segment_id")


@query("anti_processed_docs", f"WITH {DOCS_SQL} SELECT document_id FROM docs d WHERE NOT EXISTS (SELECT 1 FROM chunks c WHERE c.document_id = d.document_id)")
def anti_processed_docs(spark, sf):
    return joins.not_yet(docs(spark, sf), table(spark, sf, "chunks"), "document_id")


@query("join_links_resolve", f"""WITH {DOCS_SQL}, t AS (SELECT url_canonical AS url, min(document_id) AS target FROM docs GROUP BY 1)
SELECT d.document_id, t.target FROM docs d LEFT JOIN t ON d.url_final = t.url""")
def join_links_resolve(spark, sf):
    """The document that a final URL is known as."""
    d = docs(spark, sf, "url_final", "url_canonical")
    return joins.resolve_urls(d.select("document_id", F.col("url_final").alias("url")), d, "url").select("document_id", "target")


@query("join_links_edges", f"""WITH {DOCS_SQL}, t AS (SELECT url_canonical AS url, min(document_id) AS target FROM docs GROUP BY 1)
SELECT DISTINCT d.document_id AS src, t.target AS dst FROM docs d JOIN t ON d.url_final = t.url""")
def join_links_edges(spark, sf):
    d = docs(spark, sf, "url_final", "url_canonical")
    return joins.resolve_urls(d.select("document_id", F.col("url_final").alias("url")), d, "url").filter("target is not null").select(F.col("document_id").alias("src"), F.col("target").alias("dst")).distinct()


@query("join_neighbors", f"""WITH {SEG_SQL}, good AS (SELECT segment_id, document_id, order_index FROM seg WHERE coalesce(is_negative, 0) = 0),
a AS (SELECT segment_id, document_id, order_index FROM seg WHERE coalesce(impact_score, 0) >= 50)
SELECT a.segment_id, count(*) FILTER (b.order_index < a.order_index) AS n_before, count(*) FILTER (b.order_index > a.order_index) AS n_after
FROM a JOIN good b ON a.document_id = b.document_id AND b.order_index BETWEEN a.order_index - 2 AND a.order_index + 2 GROUP BY a.segment_id""")
def join_neighbors(spark, sf):
    """Neighbours within two places of high-scoring segments."""
    a = segments(spark, sf, "document_id", "order_index", where=F.coalesce("impact_score", F.lit(0)) >= 50)
    b = segments(spark, sf, "document_id", F.col("order_index").alias("other"), where=F.coalesce("is_negative", F.lit(0)) == 0).drop("segment_id")
    near = joins.within_places(a, b, "document_id", "order_index", "other", 2)
    return near.groupBy("segment_id").agg(F.count_if(F.col("other") < F.col("order_index")).alias("n_before"), F.count_if(F.col("other") > F.col("order_index")).alias("n_after"))


@query("join_canonical", """WITH e AS (SELECT DISTINCT * FROM entity_canonical), m AS (SELECT original_name, max(canonical_name) AS canonical_name FROM e GROUP BY 1)
SELECT e.entity_id, coalesce(m.canonical_name, e.original_name) AS name FROM e LEFT JOIN m ON e.original_name = m.original_name""")
def join_canonical(spark, sf):
    e = table(spark, sf, "entity_canonical").distinct()
    m = e.groupBy("original_name").agg(F.max("canonical_name").alias("canonical"))
    return e.join(m, "original_name", "left").select("entity_id", F.coalesce("canonical", "original_name").alias("name"))


@query("join_muni_docs", f"WITH {DOCS_SQL} SELECT DISTINCT m.ags, m.name, d.document_id FROM municipalities m JOIN docs d ON m.ags = d.municipality_id")
def join_muni_docs(spark, sf):
    m = table(spark, sf, "municipalities").select(F.col("ags"), "name").dropDuplicates(["ags"])
    return docs(spark, sf, "municipality_id").select(F.col("municipality_id").alias("ags"), "document_id").join(m, "ags").select("ags", "name", "document_id")


@query("join_registry_enrich", f"""WITH {DOCS_SQL}, n AS (SELECT municipality_id, count(*) AS n_docs, max(last_fetch) AS last_fetch FROM docs GROUP BY 1)
SELECT m.ags, coalesce(m.regierungsbezirk, m.bundesland, 'unbekannt') AS region, coalesce(n.n_docs, 0) AS n_docs, n.last_fetch FROM municipalities m LEFT JOIN n ON m.ags = n.municipality_id""")
def join_registry_enrich(spark, sf):
    n = docs(spark, sf, "municipality_id", "last_fetch").groupBy(F.col("municipality_id").alias("ags")).agg(F.count("*").alias("n_docs"), F.max("last_fetch").alias("last_fetch"))
    m = table(spark, sf, "municipalities").join(n, "ags", "left")
    return m.select("ags", F.coalesce("regierungsbezirk", "bundesland", F.lit("unbekannt")).alias("region"), F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "last_fetch")


# --- aggregates


@query("agg_status_count", f"WITH {DOCS_SQL} SELECT CASE WHEN status_code = 200 THEN 'done' WHEN status_code IS NULL THEN 'pending' ELSE 'failed' END AS status, count(*) AS n FROM docs GROUP BY 1")
def agg_status_count(spark, sf):
    return docs(spark, sf, "status_code").groupBy(F.when(F.col("status_code") == 200, "done").when(F.col("status_code").isNull(), "pending").otherwise("failed").alias("status")).agg(F.count("*").alias("n"))


@query("agg_count_distinct", "SELECT count(DISTINCT document_id) AS n_docs FROM segments WHERE contains(heading_context, 'Klimaschutz')")
def agg_count_distinct(spark, sf):
    return table(spark, sf, "segments").filter(F.col("heading_context").contains("Klimaschutz")).agg(F.countDistinct("document_id").alias("n_docs"))


@query("agg_mode_name", """WITH e AS (SELECT DISTINCT * FROM entity_canonical), n AS (SELECT entity_type, normalised_key, original_name, count(*) AS k FROM e GROUP BY ALL)
SELECT entity_type, normalised_key, original_name AS name FROM n QUALIFY row_number() OVER (PARTITION BY entity_type, normalised_key ORDER BY k DESC, length(original_name) DESC, original_name DESC) = 1""")
def agg_mode_name(spark, sf):
    """Most frequent spelling of each key, then the longest."""
    n = table(spark, sf, "entity_canonical").distinct().groupBy("entity_type", "normalised_key", "original_name").agg(F.count("*").alias("k"))
    return n.groupBy("entity_type", "normalised_key").agg(F.max_by("original_name", F.struct("k", F.char_length("original_name"), "original_name")).alias("name"))


@query("agg_entity_freq", """SELECT coalesce(canonical_name, original_name) AS name, count(*) AS n_keys, CAST(sum(frequency) AS BIGINT) AS mentions
FROM (SELECT DISTINCT original_name, entity_type, category, canonical_name, frequency FROM entity_canonical) GROUP BY 1 HAVING count(*) >= 2""")
def agg_entity_freq(spark, sf):
    e = table(spark, sf, "entity_canonical").select("original_name", "entity_type", "category", "canonical_name", "frequency").distinct()
    return e.groupBy(F.coalesce("canonical_name", "original_name").alias("name")).agg(F.count("*").alias("n_keys"), F.sum("frequency").alias("mentions")).filter("n_keys >= 2")


@query("agg_doc_group", f"""WITH {SEG_SQL}, t AS (SELECT document_id, segment_id, row_number() OVER (PARTITION BY document_id ORDER BY coalesce(impact_score, 0) DESC, segment_id) AS r FROM seg)
SELECT document_id, array_to_string(list(segment_id ORDER BY r), ',') AS top_segments FROM t WHERE r <= 6 GROUP BY 1""")
def agg_doc_group(spark, sf):
    top = passages.top_per(segments(spark, sf, "document_id", "impact_score"), "document_id", 6)
    return top.groupBy("document_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "segment_id"))), lambda x: x["segment_id"]), ",").alias("top_segments"))


@query("agg_doc_prompt", f"""WITH {SEG_SQL}, t AS (SELECT document_id, order_index, segment_id, concat_ws(': ', heading_context, substring(text, 1, 300)) AS block,
 row_number() OVER (PARTITION BY document_id ORDER BY coalesce(impact_score, 0) DESC, segment_id) AS r FROM seg)
SELECT document_id, array_to_string(list(block ORDER BY r), chr(10) || chr(10)) AS prompt FROM t WHERE r <= 5 GROUP BY 1""")
def agg_doc_prompt(spark, sf):
    """Best blocks of each document with their headings, as one text."""
    top = passages.top_per(segments(spark, sf, "document_id", "impact_score", F.concat_ws(": ", "heading_context", F.substring("text", 1, 300)).alias("block")), "document_id", 5)
    return top.groupBy("document_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "block"))), lambda x: x["block"]), "\n\n").alias("prompt"))


@query("agg_latest_population", """SELECT landkreis, coalesce(max_by(population, (population_date, ags)) FILTER (population_date IS NOT NULL), min_by(population, ags)) AS population
FROM municipalities WHERE population IS NOT NULL GROUP BY 1""")
def agg_latest_population(spark, sf):
    """The latest dated figure, or the first where none has a date."""
    m = table(spark, sf, "municipalities").filter("population is not null")
    dated = F.max_by("population", F.when(F.col("population_date").isNotNull(), F.struct("population_date", "ags")))
    return m.groupBy("landkreis").agg(F.coalesce(dated, F.min_by("population", "ags")).alias("population"))


@query("agg_first_nonnull", "SELECT landkreis, min_by(homepage_url, ags) FILTER (homepage_url IS NOT NULL) AS homepage, min_by(wikidata_qid, ags) FILTER (wikidata_qid IS NOT NULL) AS qid FROM municipalities GROUP BY 1")
def agg_first_nonnull(spark, sf):
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ags")))
    return table(spark, sf, "municipalities").groupBy("landkreis").agg(first("homepage_url").alias("homepage"), first("wikidata_qid").alias("qid"))


@query("agg_best_meta", "SELECT landkreis, ags FROM municipalities QUALIFY row_number() OVER (PARTITION BY landkreis ORDER BY is_kreisfrei DESC NULLS LAST, ags) = 1")
def agg_best_meta(spark, sf):
    return table(spark, sf, "municipalities").groupBy("landkreis").agg(F.min_by("ags", F.struct((-F.coalesce("is_kreisfrei", F.lit(-1))).alias("k"), "ags")).alias("ags"))


@query("agg_repeated_param", f"""WITH {DOCS_SQL}, q AS (SELECT document_id, unnest(string_split(regexp_extract(url_final, '\\?(.*)$', 1), '&')) AS p FROM docs)
SELECT document_id, max(n) AS most FROM (SELECT document_id, split_part(p, '=', 1) AS k, count(*) AS n FROM q WHERE p <> '' GROUP BY ALL) GROUP BY 1""")
def agg_repeated_param(spark, sf):
    """How often the most repeated parameter of a URL stands in it."""
    q = docs(spark, sf, "url_final").select("document_id", F.explode(F.split(F.regexp_extract("url_final", r"\?(.*)$", 1), "&")).alias("p")).filter("p <> ''")
    return q.groupBy("document_id", F.split_part("p", F.lit("="), F.lit(1)).alias("k")).agg(F.count("*").alias("n")).groupBy("document_id").agg(F.max("n").alias("most"))


@query("agg_links_inserted", """WITH known AS (SELECT DISTINCT document_id, url_canonical AS url FROM documents_raw), links AS (SELECT DISTINCT document_id, url_final AS url FROM documents_raw WHERE url_final IS NOT NULL)
SELECT count(*) AS inserted FROM links l WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.document_id = l.document_id AND k.url = l.url)""")
def agg_links_inserted(spark, sf):
    """How many links a write added to a table that had some of them."""
    r = table(spark, sf, "documents_raw")
    known = r.select("document_id", F.col("url_canonical").alias("url")).distinct()
    return merge.inserted(known, r.filter("url_final is not null").select("document_id", F.col("url_final").alias("url")), ["document_id", "url"]).agg(F.count("*").alias("inserted"))


# --- windows, orders and partitions


@query("win_top_per_doc", f"""WITH {SEG_SQL}, t AS (SELECT document_id, segment_id, impact_score, row_number() OVER (PARTITION BY document_id ORDER BY coalesce(impact_score, 0) DESC, segment_id) AS rank FROM seg
 WHERE length(text) >= 150 AND coalesce(is_negative, 0) = 0 AND coalesce(impact_score, 0) >= 15) SELECT document_id, segment_id, impact_score, rank FROM t WHERE rank <= 4""")
def win_top_per_doc(spark, sf):
    """Best passages of each document."""
    return passages.top_per(segments(spark, sf, "document_id", "impact_score", where=passages.good(150, 15)), "document_id", 4).select("document_id", "segment_id", "impact_score", "rank")


@query("win_prev_next", f"""WITH {SEG_SQL} SELECT segment_id, lag(segment_id) OVER w AS prev_id, lead(segment_id) OVER w AS next_id FROM seg WINDOW w AS (PARTITION BY document_id ORDER BY order_index, segment_id)""")
def win_prev_next(spark, sf):
    w = Window.partitionBy("document_id").orderBy("order_index", "segment_id")
    return segments(spark, sf, "document_id", "order_index").select("segment_id", F.lag("segment_id").over(w).alias("prev_id"), F.lead("segment_id").over(w).alias("next_id"))


@query("win_heading", f"""WITH {SEG_SQL} SELECT segment_id, last_value(CASE WHEN segment_type = 'heading' THEN text END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY order_index, segment_id ROWS UNBOUNDED PRECEDING) AS heading FROM seg""")
def win_heading(spark, sf):
    """Heading under which a segment stands."""
    w = Window.partitionBy("document_id").orderBy("order_index", "segment_id").rowsBetween(Window.unboundedPreceding, 0)
    s = segments(spark, sf, "document_id", "order_index", F.when(F.col("segment_type") == "heading", F.col("text")).alias("own"))
    return s.select("segment_id", F.last("own", ignorenulls=True).over(w).alias("heading"))


@query("win_heading_path", """WITH h AS (SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord, {'level': CAST(l_quantity AS INTEGER) % 6 + 1, 'text': 'P' || l_partkey} AS h FROM lineitem),
l AS (SELECT doc, ord, list(h) OVER (PARTITION BY doc ORDER BY ord) AS l FROM h)
SELECT doc, ord, array_to_string(list_transform(list_filter(l, lambda x, i: len(list_filter(l[i + 1 :], lambda y: y.level <= x.level)) = 0), lambda x: x.text), ' > ') AS path FROM l""")
def win_heading_path(spark, sf):
    """Breadcrumb of every line; the lines of an order stand in for headings of six levels."""
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    h = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"), place.alias("ord"), (F.col("l_quantity").cast("int") % 6 + 1).alias("level"), F.concat(F.lit("P"), "l_partkey").alias("text"))
    return passages.heading_paths(h, "doc", "ord", "level", "text").select("doc", "ord", "path")


@query("win_autostop", f"""WITH {DOCS_SQL}, g AS (SELECT *, sum(CASE WHEN raw_ext = '.pdf' THEN 1 ELSE 0 END) OVER (PARTITION BY municipality_id ORDER BY first_fetch, document_id) AS island FROM docs),
r AS (SELECT municipality_id, document_id, first_fetch, row_number() OVER (PARTITION BY municipality_id, island ORDER BY first_fetch, document_id) - CASE WHEN island > 0 THEN 1 ELSE 0 END AS since FROM g),
t AS (SELECT unnest([20, 300]) AS threshold)
SELECT threshold, document_id, since, coalesce(max(since) OVER (PARTITION BY threshold, municipality_id ORDER BY first_fetch, document_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= threshold AS stopped FROM r, t""")
def win_autostop(spark, sf):
    """Pages since a municipality's last PDF, and whether its crawl had stopped before: after 300 of them, and after 20."""
    d = docs(spark, sf, "municipality_id", "raw_ext", "first_fetch").withColumn("found", F.coalesce(F.col("raw_ext") == ".pdf", F.lit(False)))
    since = passages.since_last(d, ["municipality_id"], ["first_fetch", "document_id"], "found")
    before = Window.partitionBy("municipality_id").orderBy("first_fetch", "document_id").rowsBetween(Window.unboundedPreceding, -1)
    run = since.withColumn("longest", F.coalesce(F.max("since").over(before), F.lit(0)))
    return run.select(F.explode(F.array(F.lit(20), F.lit(300))).alias("threshold"), "document_id", "since", "longest").select("threshold", "document_id", "since", (F.col("longest") >= F.col("threshold")).alias("stopped"))


@query("win_dedupe_first", f"""WITH {SEG_SQL} SELECT segment_id FROM seg QUALIFY row_number() OVER (PARTITION BY document_id, segment_hash ORDER BY order_index, segment_id) = 1""")
def win_dedupe_first(spark, sf):
    """First of the segments of equal text of a document."""
    return table(spark, sf, "segments").groupBy("document_id", "segment_hash").agg(F.min_by("segment_id", F.struct("order_index", "segment_id")).alias("segment_id")).select("segment_id")


_PRIO_SQL = f"""(10 + CASE WHEN contains(lower(u), '.pdf') THEN 300 ELSE 0 END + CASE WHEN {' OR '.join(f"contains(lower(u), '{m}')" for m in lexicon.COUNCIL_MARKS)} THEN 200 ELSE 0 END
 + CASE WHEN regexp_matches(lower(u), '{lexicon.re2(lexicon.POSITIVE)}') THEN 150 ELSE 0 END + CASE WHEN regexp_matches(lower(a), '{lexicon.re2(lexicon.POSITIVE)}') THEN 100 ELSE 0 END
 - CASE WHEN regexp_matches(lower(u), '{lexicon.re2(lexicon.NEGATIVE)}') THEN 50 ELSE 0 END - CASE WHEN regexp_matches(lower(a), '{lexicon.re2(lexicon.NEGATIVE)}') THEN 20 ELSE 0 END)"""
_LINK_SQL = f"{DOCS_SQL}, t AS (SELECT document_id, max(json_extract_string(meta_json, '$.title')) AS title FROM documents_raw GROUP BY 1), l AS (SELECT d.document_id, municipality_id, url_canonical AS u, coalesce(title, '') AS a, first_fetch AS seq FROM docs d JOIN t USING (document_id))"


_DEPTH_SQL = "len(list_filter(string_split(regexp_extract(u, '^[^:]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> ''))"


def _links(spark, sf):
    title = table(spark, sf, "documents_raw").groupBy("document_id").agg(F.max(F.get_json_object("meta_json", "$.title")).alias("title"))
    return docs(spark, sf, "municipality_id", "url_canonical", "first_fetch").join(title, "document_id").select("document_id", "municipality_id", "url_canonical", F.coalesce("title", F.lit("")).alias("anchor"), F.col("first_fetch").alias("seq"))


@query("fn_url_priority", f"WITH {_LINK_SQL} SELECT document_id, {_PRIO_SQL} AS priority FROM l")
def fn_url_priority(spark, sf):
    return _links(spark, sf).select("document_id", urls.priority(F.col("url_canonical"), F.col("anchor")).alias("priority"))


@query("win_frontier_rank", f"""WITH {_LINK_SQL} SELECT municipality_id, document_id, row_number() OVER (PARTITION BY municipality_id ORDER BY {_PRIO_SQL} DESC, {_DEPTH_SQL}, seq, document_id) AS rank FROM l""")
def win_frontier_rank(spark, sf):
    """Order in which each site's frontier is fetched: priority, then depth, then first come."""
    w = Window.partitionBy("municipality_id").orderBy(F.desc("priority"), "depth", "seq", "document_id")
    ranked = _links(spark, sf).withColumn("priority", urls.priority(F.col("url_canonical"), F.col("anchor"))).withColumn("depth", urls.depth(F.col("url_canonical")))
    return ranked.select("municipality_id", "document_id", F.row_number().over(w).alias("rank"))


@query("topk_score", f"WITH {SEG_SQL} SELECT segment_id, impact_score FROM seg ORDER BY impact_score DESC NULLS LAST, segment_id LIMIT 100")
def topk_score(spark, sf):
    return segments(spark, sf, "impact_score").orderBy(F.desc_nulls_last("impact_score"), "segment_id").limit(100)


@query("topk_two_key", f"WITH {SEG_SQL} SELECT segment_id FROM seg ORDER BY impact_score DESC NULLS LAST, hit_count DESC NULLS LAST, segment_id LIMIT 100")
def topk_two_key(spark, sf):
    return segments(spark, sf, "impact_score", "hit_count").orderBy(F.desc_nulls_last("impact_score"), F.desc_nulls_last("hit_count"), "segment_id").select("segment_id").limit(100)


@query("topk_fallback", f"WITH {SEG_SQL}, m AS (SELECT * FROM seg WHERE contains(text, 'Raumfahrt')) SELECT segment_id FROM m UNION ALL (SELECT segment_id FROM seg WHERE NOT EXISTS (SELECT 1 FROM m) ORDER BY impact_score DESC NULLS LAST, segment_id LIMIT 10)")
def topk_fallback(spark, sf):
    """Matching segments, or the ten best where none matches."""
    s = segments(spark, sf, "impact_score", F.contains("text", F.lit("Raumfahrt")).alias("hit"))
    return passages.or_best(s, F.col("hit"), 10).select("segment_id")


@query("sort_offset", f"WITH {DOCS_SQL} SELECT document_id FROM docs ORDER BY document_id LIMIT 25 OFFSET 50")
def sort_offset(spark, sf):
    return docs(spark, sf).orderBy("document_id").offset(50).limit(25)


@query("sample_random")
def sample_random(spark, sf):
    """A repeatable sample: the segments with the smallest seeded hash."""
    return segments(spark, sf).orderBy(F.xxhash64("segment_id", F.lit(42)), "segment_id").limit(200)


@query("part_range_shards", """WITH m AS (SELECT ags, row_number() OVER (ORDER BY ags) AS rn, count(*) OVER () AS n FROM municipalities)
SELECT ags, CASE WHEN n // 20 = 0 THEN 19 ELSE least((rn - 1) // (n // 20), 19) END AS shard FROM m""")
def part_range_shards(spark, sf):
    """Twenty contiguous shards of equal size, the rest in the last."""
    return passages.range_shards(table(spark, sf, "municipalities").select("ags"), "ags", 20)


@query("batch_iter", "SELECT ags, (row_number() OVER (ORDER BY ags) - 1) // 64 AS batch FROM municipalities")
def batch_iter(spark, sf):
    m = passages.numbered(table(spark, sf, "municipalities").select("ags"), "ags")
    return m.select("ags", F.expr("(rn - 1) div 64").alias("batch"))
