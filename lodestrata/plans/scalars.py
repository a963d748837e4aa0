"""Queries over the scalar functions and the sets built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lexicon, text, urls
from ..session import table
from .catalog import cases, cases_sql, query
from .store import DOCS_SQL, SEG_SQL, _links, chunks, docs, segments



@query("fn_segment_score", f"""WITH {SEG_SQL} SELECT segment_id, 25 * len(regexp_extract_all(text, '{lexicon.re2(lexicon.POSITIVE)}')) - 80 * CAST(regexp_matches(text, '{lexicon.re2(lexicon.NEGATIVE)}') AS INTEGER)
 + least(length(text) // 250, 8) AS score FROM seg WHERE text IS NOT NULL""")
def fn_segment_score(spark, sf):
    return segments(spark, sf, text.segment_score(F.col("text")).alias("score"), where="text is not null")


@query("fn_clean_ws", f"WITH {SEG_SQL} SELECT segment_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS clean FROM seg")
def fn_clean_ws(spark, sf):
    return segments(spark, sf, text.clean_ws(F.col("text")).alias("clean"))


@query("fn_pdf_clean", f"WITH {SEG_SQL} SELECT segment_id, sha256(regexp_replace(text, '[ \\t]{{3,}}', ' ', 'g')) AS h FROM seg WHERE page_ref IS NOT NULL")
def fn_pdf_clean(spark, sf):
    return segments(spark, sf, F.sha2(text.page_clean(F.col("text")), 256).alias("h"), where="page_ref is not null")


@query("fn_page_subchunk")
def fn_page_subchunk(spark, sf):
    """Pieces of the extracted pages."""
    p = segments(spark, sf, "order_index", "text", where="page_ref is not null and text is not null")
    return p.select("segment_id", "order_index", F.posexplode(text.page_pieces(F.col("text"))).alias("i", "piece")).select("segment_id", (F.col("order_index") + F.col("i")).alias("piece_order"), "piece")


_TOK = "list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')"


@query("fn_token_chunks", f"""WITH {SEG_SQL}, t AS (SELECT segment_id, {_TOK} AS tok FROM seg), n AS (SELECT segment_id, tok, len(tok) AS n FROM t WHERE len(tok) > 0),
w AS (SELECT segment_id, tok, n, unnest(range(0, CASE WHEN n <= 60 THEN 1 ELSE CAST(ceil((n - 6) / 54.0) AS BIGINT) END)) AS i FROM n)
SELECT segment_id, i AS chunk_index, i * 54 AS start_token, least(i * 54 + 60, n) AS end_token, sha256(array_to_string(tok[i * 54 + 1 : least(i * 54 + 60, n)], ' ')) AS chunk_hash FROM w""")
def fn_token_chunks(spark, sf):
    """Windows of 60 tokens sharing 6, with the hash of each."""
    tokens = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    t = table(spark, sf, "segments").select("segment_id", tokens.alias("tok")).filter(F.size("tok") > 0)
    w = t.select("segment_id", F.posexplode(text.token_windows(F.col("tok"), 60, 6)).alias("chunk_index", "w"))
    return w.select("segment_id", "chunk_index", F.col("w.start").alias("start_token"), F.col("w.end").alias("end_token"), F.sha2(F.array_join("w.tokens", " "), 256).alias("chunk_hash")).distinct()


@query("fn_count_tokens", f"WITH {SEG_SQL} SELECT segment_id, len({_TOK}) AS n FROM seg WHERE text IS NOT NULL")
def fn_count_tokens(spark, sf):
    return segments(spark, sf, F.size(F.filter(F.split("text", r"\s+"), lambda x: x != "")).alias("n"), where="text is not null")


@query("fn_sha256", f"WITH {SEG_SQL} SELECT segment_id, sha256(text) AS h FROM seg")
def fn_sha256(spark, sf):
    return segments(spark, sf, F.sha2("text", 256).alias("h"))


@query("fn_sha1", f"WITH {DOCS_SQL} SELECT document_id, sha1(url_canonical) AS cache_key FROM docs")
def fn_sha1(spark, sf):
    return docs(spark, sf, "url_canonical").select("document_id", F.sha1("url_canonical").alias("cache_key"))


_ART = "|".join(lexicon.ARTICLES)
_NORM_SQL = f"""lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(original_name), '(?i)\\s*\\b({lexicon.LEGAL_SUFFIXES})\\s*$', ''),
 '[^\\p{{L}}\\p{{N}}_\\- ]+', ' ', 'g'), '(?i)\\b({_ART})\\b', ' ', 'g'), '\\s+', ' ', 'g')))"""


@query("fn_entity_norm", f"SELECT DISTINCT entity_id, {_NORM_SQL} AS norm FROM entity_canonical")
def fn_entity_norm(spark, sf):
    return table(spark, sf, "entity_canonical").select("entity_id", text.entity_norm(F.col("original_name")).alias("norm")).distinct()


@query("gr_entity_key", "SELECT DISTINCT entity_id, concat_ws('::', entity_type, category, trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(original_name, '\\s+', ' ', 'g'))), '[^\\p{L}\\p{N}_\\- ]+', '', 'g'), '\\s+', ' ', 'g'))) AS key FROM entity_canonical")
def gr_entity_key(spark, sf):
    return table(spark, sf, "entity_canonical").select("entity_id", text.entity_key(F.col("original_name"), F.col("entity_type"), F.col("category")).alias("key")).distinct()


@query("gr_safe_rel", f"SELECT DISTINCT document_type, CASE WHEN replace(upper(trim(document_type)), ' ', '_') IN ({', '.join(repr(r) for r in lexicon.RELATIONS)}) THEN replace(upper(trim(document_type)), ' ', '_') ELSE '{lexicon.ANY_RELATION}' END AS rel FROM documents")
def gr_safe_rel(spark, sf):
    return table(spark, sf, "documents").select("document_type", text.safe_relation(F.col("document_type")).alias("rel")).distinct()


_MONEY_RE = r"[0-9]{1,3}(?:\.[0-9]{3})*(?:,[0-9]+)?\s?(?:€|[Ee]uros?|Mio\.?|TEUR)"


@query("fn_money", f"WITH {SEG_SQL}, a AS (SELECT segment_id, unnest(regexp_extract_all(text, '{_MONEY_RE}')) AS amount FROM seg) SELECT segment_id, amount, count(*) AS n FROM a GROUP BY ALL")
def fn_money(spark, sf):
    """Amounts of money in each segment."""
    found = F.regexp_extract_all("text", F.lit(_MONEY_RE), F.lit(0))
    a = segments(spark, sf, found.alias("found"), where=F.size(found) > 0).select("segment_id", F.explode("found").alias("amount"))
    return a.groupBy("segment_id", "amount").agg(F.count("*").alias("n"))


_TRIGGER = r"(?i)(förder|zuschuss|invest|haushalt|kfw|bafa|efre|eler)"
_ORG = r"(?i)(gmbh|e\.\s?v\.|stadtwerke|zweckverband|landratsamt|ministerium)"


@query("fn_finance_trigger", f"WITH {SEG_SQL} SELECT segment_id, len(regexp_extract_all(text, '{_TRIGGER}')) AS n FROM seg WHERE regexp_matches(text, '{_TRIGGER}')")
def fn_finance_trigger(spark, sf):
    p = _TRIGGER.replace("(?i)", "(?iu)")
    return segments(spark, sf, F.regexp_count("text", F.lit(p)).alias("n"), where=F.col("text").rlike(p))


@query("fn_org_hint", f"WITH {SEG_SQL} SELECT segment_id FROM seg WHERE regexp_matches(text, '{_ORG}')")
def fn_org_hint(spark, sf):
    return segments(spark, sf, where=F.col("text").rlike(_ORG))


@query("fn_ags_norm", "SELECT ags, CASE WHEN length(d) = 8 THEN d ELSE '' END AS norm FROM (SELECT ags, CASE WHEN length(x) = 7 THEN '0' || x ELSE x END AS d FROM (SELECT ags, regexp_replace(coalesce(ags, ''), '[^0-9]', '', 'g') AS x FROM municipalities))")
def fn_ags_norm(spark, sf):
    return table(spark, sf, "municipalities").select("ags", text.ags_norm(F.col("ags")).alias("norm"))


@query("fn_http_norm", """SELECT ags, CASE WHEN regexp_matches(u, '^[hH][tT][tT][pP][sS]?://([^/?#@]*@)?[^/?#:@]+') THEN u ELSE '' END AS url FROM
 (SELECT ags, CASE WHEN starts_with(trim(coalesce(homepage_url, '')), '//') THEN 'https:' || trim(homepage_url) ELSE trim(coalesce(homepage_url, '')) END AS u FROM municipalities)""")
def fn_http_norm(spark, sf):
    return table(spark, sf, "municipalities").select("ags", urls.http_norm(F.col("homepage_url")).alias("url"))


@query("fn_wkt_point", """SELECT ags, TRY_CAST(regexp_extract(p, 'Point\\(([-0-9.]+) ([-0-9.]+)\\)', 1) AS DOUBLE) AS lon, TRY_CAST(regexp_extract(p, 'Point\\(([-0-9.]+) ([-0-9.]+)\\)', 2) AS DOUBLE) AS lat
FROM (SELECT ags, printf('Point(%.6f %.6f)', lon, lat) AS p FROM municipalities WHERE lon IS NOT NULL AND lat IS NOT NULL)""")
def fn_wkt_point(spark, sf):
    """Round trip of coordinates through their text form."""
    p = table(spark, sf, "municipalities").filter("lon is not null and lat is not null").select("ags", F.format_string("Point(%.6f %.6f)", "lon", "lat").alias("p"))
    part = lambda i: F.regexp_extract("p", r"Point\(([-0-9.]+) ([-0-9.]+)\)", i).try_cast("double")
    return p.select("ags", part(1).alias("lon"), part(2).alias("lat"))


@query("fn_admin_label", f"""SELECT ags, CASE WHEN starts_with(landkreis, 'Landkreis ') THEN substr(landkreis, 11) END AS landkreis,
 CASE WHEN bundesland IN ({', '.join(repr(r) for r in lexicon.REGIONS)}) THEN bundesland END AS region, coalesce(is_kreisfrei, 0) = 1 AS is_city FROM municipalities""")
def fn_admin_label(spark, sf):
    m = table(spark, sf, "municipalities")
    return m.select(
        "ags", F.when(F.col("landkreis").startswith("Landkreis "), F.expr("substr(landkreis, 11)")).alias("landkreis"),
        F.when(F.col("bundesland").isin(lexicon.REGIONS), F.col("bundesland")).alias("region"), (F.coalesce("is_kreisfrei", F.lit(0)) == 1).alias("is_city"),
    )


@query("fn_norm_name", "SELECT DISTINCT entity_id, translate(trim(regexp_replace(original_name, '\\s+', ' ', 'g')), '–—', '--') AS name FROM entity_canonical")
def fn_norm_name(spark, sf):
    return table(spark, sf, "entity_canonical").select("entity_id", text.norm_name(F.col("original_name")).alias("name")).distinct()


DOMAINS = [
    ("https://www.Musterstadt.example/rathaus", "musterstadt.example"), ("WWW.beispiel.example.", "beispiel.example"), ("//www.a.example:8080/x", "a.example"),
    ("b.example:443", "b.example"), ("  c.example ", "c.example"), ("wwwd.example", "wwwd.example"), ("", ""), (None, ""),
]


@query("fn_norm_domain", f"""SELECT ags AS item, rtrim(regexp_replace(regexp_replace(CASE WHEN contains(d, '://') THEN regexp_extract(d, '://([^/?#]*)', 1) ELSE d END, ':.*$', ''), '^www[.]', ''), '.') AS domain
FROM (SELECT ags, lower(trim(coalesce(homepage_url, ''))) AS d FROM municipalities) UNION ALL SELECT coalesce(item, '-'), domain FROM {cases_sql(DOMAINS, "item, domain")}""")
def fn_norm_domain(spark, sf):
    """Of every homepage, and of given cases."""
    m = table(spark, sf, "municipalities").select(F.col("ags").alias("item"), F.col("homepage_url").alias("d"))
    given = cases(spark, DOMAINS, "d string, domain string").select(F.coalesce("d", F.lit("-")).alias("item"), "d")
    return m.unionByName(given).select("item", urls.norm_domain(F.col("d")).alias("domain"))


@query("set_allowed_norm", """SELECT ags, array_to_string(CASE WHEN len(l) > 0 THEN l WHEN h <> '' THEN [h] ELSE [] END, '|') AS domains FROM (
 SELECT ags, list_sort(list_distinct(list_filter(list_transform(string_split(coalesce(allowed_domains, ''), '|'), lambda d: rtrim(regexp_replace(lower(trim(d)), ':.*$', ''), '.')), lambda d: d <> ''))) AS l,
 lower(regexp_extract(coalesce(homepage_url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)', 2)) AS h FROM municipalities)""")
def set_allowed_norm(spark, sf):
    return table(spark, sf, "municipalities").select("ags", F.array_join(urls.allowed_domains(F.col("allowed_domains"), F.coalesce("homepage_url", F.lit(""))), "|").alias("domains"))


@query("set_domains_norm", """SELECT ags, array_to_string(list_sort(list_distinct(list_concat(l, list_transform(l, lambda d: CASE WHEN starts_with(d, 'www.') THEN substr(d, 5) ELSE 'www.' || d END)))), '|') AS domains
FROM (SELECT ags, list_filter(string_split(lower(coalesce(allowed_domains, '')), '|'), lambda d: d <> '') AS l FROM municipalities)""")
def set_domains_norm(spark, sf):
    """Domains with and without www, sorted."""
    m = table(spark, sf, "municipalities").select("ags", F.filter(F.split(F.lower(F.coalesce("allowed_domains", F.lit(""))), r"\|"), lambda d: d != "").alias("l"))
    twins = F.transform("l", lambda d: F.when(F.startswith(d, F.lit("www.")), F.substring(d, 5, 1000)).otherwise(F.concat(F.lit("www."), d)))
    return m.select("ags", F.array_join(F.array_sort(F.array_distinct(F.concat("l", twins))), "|").alias("domains"))


#: What canonicalisation has to give.
CANONICAL = [
    ("HTTP://Www.Stadt.Example:80/a//b/./c/../d/?b=2&a=1#top", "http://www.stadt.example/a/b/d?a=1&b=2"), ("https://stadt.example:443", "https://stadt.example/"),
    ("https://stadt.example:8443/x/", "https://stadt.example:8443/x"), ("http://stadt.example:443/", "http://stadt.example:443/"), ("https://stadt.example/?utm_source=x&PK_kwd=y&fbclid=z&q=1", "https://stadt.example/?q=1"),
    ("https://stadt.example/s?B=2&a=9&a=1&c", "https://stadt.example/s?a=1&a=9&B=2&c="), ("https://stadt.example/s?q=w%c3%a4rme+netz&r=a%2Fb", "https://stadt.example/s?q=w%C3%A4rme+netz&r=a%2Fb"),
    ("https://stadt.example/a/../../b", "https://stadt.example/b"), ("  https://stadt.example/Pfad  ", "https://stadt.example/Pfad"), ("https://stadt.example?x=~*", "https://stadt.example/?x=~%2A"),
    ("https://nutzer@stadt.example/x", "https://nutzer@stadt.example/x"), ("ftp://stadt.example/x", ""), ("mailto:a@stadt.example", ""), ("//stadt.example/x", ""), ("stadt.example", ""), ("https:///x", ""), ("", ""),
    ("https://stadt.example/x?PHPSESSID=1", "https://stadt.example/x"), ("https://stadt.example/x?a=1&&b=", "https://stadt.example/x?a=1&b="), ("https://[::1]:443/x", "https://[::1]/x"),
]


@query("fn_url_canonical", f"""WITH {DOCS_SQL}, c AS (SELECT document_id, url_canonical AS u, regexp_extract(url_canonical, '^([a-z]+)://', 1) AS scheme FROM docs WHERE url_canonical IS NOT NULL)
SELECT 'd' || document_id AS item, CASE WHEN regexp_matches(u, '^https?://[^/]+$') THEN u || '/' WHEN regexp_matches(u, '^https?://[^/]+/$') THEN u ELSE rtrim(u, '/') END || '?a=1&b=2' AS url FROM c
UNION ALL SELECT item, url FROM {cases_sql(CANONICAL, "item, url")}""")
def fn_url_canonical(spark, sf):
    """Every URL, disguised by case, port, dots, tracking and a fragment, and given cases."""
    u = F.col("url_canonical")
    net = F.regexp_extract(u, r"^[^:]+://([^/?#]*)", 1)
    port = F.when(F.startswith(u, F.lit("https")), ":443").otherwise(":80")
    odd = F.concat(F.upper(urls.scheme(u)), F.lit("://"), F.upper(net), port, F.lit("/./"), F.regexp_extract(u, r"^[^:]+://[^/?#]*/?([^?#]*)", 1), F.lit("//x/../?b=2&utm_campaign=z&a=1&gclid=0#oben"))
    d = docs(spark, sf, "url_canonical").filter("url_canonical is not null").select(F.concat(F.lit("d"), "document_id").alias("item"), odd.alias("u"))
    given = cases(spark, CANONICAL, "u string, url string").select(F.col("u").alias("item"), "u")
    return d.unionByName(given).select("item", urls.canonical(F.col("u")).alias("url"))


BASE = "https://stadt.example/a/b/seite.html?x=1"
#: References on the page ``BASE`` and what they mean.
JOINED = [
    ("/klima", "https://stadt.example/klima"), ("c.html", "https://stadt.example/a/b/c.html"), ("../c.html", "https://stadt.example/a/c.html"), ("../../../c", "https://stadt.example/c"),
    ("./c/../d/", "https://stadt.example/a/b/d/"), ("?y=2", "https://stadt.example/a/b/seite.html?y=2"), ("#oben", "https://stadt.example/a/b/seite.html?x=1#oben"), ("//cdn.example/z", "https://cdn.example/z"),
    ("http://andere.example/p?q#f", "http://andere.example/p?q#f"), ("mailto:a@b.example", "mailto:a@b.example"), ("", "https://stadt.example/a/b/seite.html?x=1"), ("/a/./b/../c?d#e", "https://stadt.example/a/c?d#e"), ("..", "https://stadt.example/a/"),
]


@query("fn_urljoin", f"WITH {DOCS_SQL} SELECT 'd' || document_id AS item, regexp_extract(url_canonical, '^([^:]+://[^/?#]*)', 1) || '/klima?x' AS url FROM docs UNION ALL SELECT href, url FROM {cases_sql(JOINED, 'href, url')}")
def fn_urljoin(spark, sf):
    """A way up to the root from every document, and given references."""
    up = F.concat(F.repeat(F.lit("../"), urls.depth(F.col("url_canonical")) + 1), F.lit("./klima?x"))
    d = docs(spark, sf, "url_canonical").select(F.concat(F.lit("d"), "document_id").alias("item"), F.col("url_canonical").alias("base"), up.alias("href"))
    given = cases(spark, JOINED, "href string, url string").select(F.col("href").alias("item"), F.lit(BASE).alias("base"), "href")
    return d.unionByName(given).select("item", urls.join(F.col("base"), F.col("href")).alias("url"))


@query("fn_seed_paths", f"SELECT ags, rtrim(homepage_url, '/') || p AS url, CASE WHEN p = '' THEN 100 ELSE 80 END AS priority FROM municipalities, (SELECT unnest(['', {', '.join(repr(p) for p in lexicon.SEED_PATHS)}]) AS p) WHERE homepage_url IS NOT NULL AND homepage_url <> ''")
def fn_seed_paths(spark, sf):
    """Homepage and the fixed entry paths of each municipality."""
    m = table(spark, sf, "municipalities").filter("homepage_url is not null and homepage_url <> ''")
    p = m.select("ags", "homepage_url", F.explode(F.array(F.lit(""), *[F.lit(x) for x in lexicon.SEED_PATHS])).alias("p"))
    return p.select("ags", F.concat(F.rtrim("homepage_url", F.lit("/")), "p").alias("url"), F.when(F.col("p") == "", 100).otherwise(80).alias("priority"))


@query("fn_dot_cosine", "SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 6) AS dot FROM embeddings")
def fn_dot_cosine(spark, sf):
    e = F.col("embedding").cast("array<double>")
    return table(spark, sf, "embeddings").select("vec_id", F.round(F.aggregate(F.zip_with(e, e, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x), 6).alias("dot"))


@query("topk_vector", """WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0)
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q.q), 6) AS similarity FROM embeddings, q WHERE vec_id <> 0 ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), q.q) DESC, vec_id LIMIT 8""")
def topk_vector(spark, sf):
    """The eight vectors most similar to one."""
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    q = e.filter("vec_id = 0").select(F.col("e").alias("q"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    s = e.filter("vec_id <> 0").crossJoin(F.broadcast(q)).withColumn("s", dot("e", "q") / F.sqrt(dot("e", "e") * dot("q", "q")))
    return s.orderBy(F.desc("s"), "vec_id").limit(8).select("vec_id", F.round("s", 6).alias("similarity"))


@query("fn_json_dump", "SELECT DISTINCT entity_id, '{\"name\":' || to_json(original_name) || ',\"type\":' || to_json(entity_type) || '}' AS j FROM entity_canonical WHERE original_name IS NOT NULL AND entity_type IS NOT NULL")
def fn_json_dump(spark, sf):
    e = table(spark, sf, "entity_canonical").filter("original_name is not null and entity_type is not null")
    return e.select("entity_id", F.to_json(F.struct(F.col("original_name").alias("name"), F.col("entity_type").alias("type"))).alias("j")).distinct()


@query("fn_prompt_context", f"WITH {SEG_SQL} SELECT segment_id, concat_ws(chr(10) || chr(10), 'Überschrift: ' || heading_context, 'Seite: ' || page_ref, 'Text: ' || substring(text, 1, 200)) AS prompt FROM seg")
def fn_prompt_context(spark, sf):
    """Prompt of a segment from what is known of it."""
    return segments(spark, sf, F.concat_ws("\n\n", F.concat(F.lit("Überschrift: "), "heading_context"), F.concat(F.lit("Seite: "), "page_ref"), F.concat(F.lit("Text: "), F.substring("text", 1, 200))).alias("prompt"))


@query("fn_prompt_report", """SELECT 'GRUPPE: ' || landkreis || chr(10) || chr(10) || 'ORTE:' || chr(10) || array_to_string(list('  - ' || name ORDER BY name), chr(10)) AS prompt FROM (SELECT DISTINCT landkreis, name FROM municipalities WHERE landkreis IS NOT NULL AND name IS NOT NULL) GROUP BY landkreis""")
def fn_prompt_report(spark, sf):
    """Prompt for a report of a group from its members, in order."""
    m = table(spark, sf, "municipalities").filter("landkreis is not null and name is not null").select("landkreis", "name").distinct()
    lines = F.array_join(F.transform(F.array_sort(F.collect_list("name")), lambda n: F.concat(F.lit("  - "), n)), "\n")
    return m.groupBy("landkreis").agg(lines.alias("lines")).select(F.concat_ws("\n", F.concat(F.lit("GRUPPE: "), "landkreis"), F.lit(""), F.lit("ORTE:"), "lines").alias("prompt"))


@query("fn_prompt_gleaning", f"WITH {SEG_SQL} SELECT segment_id, concat_ws(chr(10) || chr(10), 'Text: ' || substring(text, 1, 200), 'Gefunden: ' || heading_context, 'Was fehlt noch?') AS prompt FROM seg WHERE text IS NOT NULL")
def fn_prompt_gleaning(spark, sf):
    """Second prompt for a segment, with what the first round found."""
    prompt = F.concat_ws("\n\n", F.concat(F.lit("Text: "), F.substring("text", 1, 200)), F.concat(F.lit("Gefunden: "), "heading_context"), F.lit("Was fehlt noch?"))
    return segments(spark, sf, prompt.alias("prompt"), where="text is not null")


@query("set_word_overlap", f"""WITH {SEG_SQL}, w AS (SELECT segment_id, list_distinct(list_filter(regexp_split_to_array(lower(heading_context), '\\s+'), lambda x: length(x) > 3)) AS h,
 list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: length(x) > 3)) AS t FROM seg WHERE heading_context IS NOT NULL AND text IS NOT NULL) SELECT segment_id, len(list_intersect(h, t)) AS overlap FROM w""")
def set_word_overlap(spark, sf):
    """Words that a segment shares with its heading."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"\s+"), lambda x: F.char_length(x) > 3))
    return segments(spark, sf, F.size(F.array_intersect(words("heading_context"), words("text"))).alias("overlap"), where="heading_context is not null and text is not null")


@query("set_union_all", f"WITH {SEG_SQL} SELECT 'segment' AS kind, count(*) AS n FROM seg UNION ALL SELECT 'chunk', count(DISTINCT chunk_id) FROM chunks UNION ALL SELECT 'document', count(DISTINCT document_id) FROM documents_raw")
def set_union_all(spark, sf):
    count = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    return count(segments(spark, sf), "segment").unionByName(count(chunks(spark, sf), "chunk")).unionByName(count(docs(spark, sf), "document"))


@query("udtf_chunk", f"""WITH {SEG_SQL}, t AS (SELECT segment_id, heading_context, {_TOK} AS tok FROM seg), n AS (SELECT *, len(tok) AS n FROM t WHERE len(tok) > 0),
w AS (SELECT *, unnest(range(0, CASE WHEN n <= 80 THEN 1 ELSE CAST(ceil((n - 20) / 60.0) AS BIGINT) END)) AS i FROM n)
SELECT segment_id, i AS chunk_index, heading_context, i * 60 AS start_token, least(i * 60 + 80, n) AS end_token, least(i * 60 + 80, n) - i * 60 AS token_count, array_to_string(tok[i * 60 + 1 : least(i * 60 + 80, n)], ' ') AS text FROM w""")
def udtf_chunk(spark, sf):
    """Chunks of 80 tokens sharing 20, with their texts."""
    tokens = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    t = segments(spark, sf, "heading_context", tokens.alias("tok"), where="text is not null").filter(F.size("tok") > 0)
    w = t.select("segment_id", "heading_context", F.posexplode(text.token_windows(F.col("tok"), 80, 20)).alias("chunk_index", "w"))
    return w.select(
        "segment_id", "chunk_index", "heading_context", F.col("w.start").alias("start_token"), F.col("w.end").alias("end_token"),
        F.size("w.tokens").alias("token_count"), F.array_join("w.tokens", " ").alias("text"),
    )
