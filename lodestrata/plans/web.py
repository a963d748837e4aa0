"""Queries over pages and services: parsing, fetching, list pages, page metadata, structured bindings and model replies."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import Config
from ..functions import urls
from ..models import offline
from ..operators import joins
from ..session import stage_table, table
from ..sources import fetch, html, wiki
from .catalog import cases, cases_sql, query
from .store import DOCS_SQL, SEG_SQL, docs, segments

_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_PAGE_SQL = f"""{DOCS_SQL}, {SEG_SQL}, clean AS (SELECT document_id, order_index, segment_id, segment_type, trim(regexp_replace(text, '{_SPACE}', ' ', 'g')) AS t FROM seg WHERE page_ref IS NULL AND text IS NOT NULL),
parsed AS (SELECT document_id, CAST(row_number() OVER w - 1 AS INTEGER) AS order_index, segment_type, t AS text, CASE WHEN segment_type <> 'heading' THEN last_value(CASE WHEN segment_type = 'heading' THEN t END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) END AS heading_context
 FROM clean WHERE length(t) >= 30 WINDOW w AS (PARTITION BY document_id ORDER BY order_index, segment_id)),
page AS (SELECT DISTINCT c.document_id, d.url_canonical AS url FROM clean c JOIN docs d ON c.document_id = d.document_id),
link AS (SELECT document_id, url, coalesce(lead(url) OVER (ORDER BY document_id), url) AS next_url FROM page)"""


def _pages(spark, sf):
    """(document_id, url, html): pages made of the stored segments, with links of all kinds; the last one leads to the next document."""
    tag = F.when(F.col("segment_type") == "heading", "h2").when(F.col("segment_type") == "list_item", "li").otherwise("p")
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    s = segments(spark, sf, "document_id", "order_index", "segment_type", "text", where="page_ref is null and text is not null")
    parts = s.select("document_id", F.struct("order_index", "segment_id", F.concat(F.lit("<"), tag, F.lit(">"), body, F.lit("</"), tag, F.lit(">")).alias("h")).alias("x"))
    content = parts.groupBy("document_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["h"]), "\n").alias("content"))
    d = docs(spark, sf, "url_canonical").join(content, "document_id").withColumnRenamed("url_canonical", "url")
    following = joins.following(d.select("document_id", "url"), "document_id", "url")
    d = d.join(following, "document_id")
    links = F.concat(
        F.lit("<a href='./klima.html#oben'>Klima  <b>hier</b></a><a href='mailto:a@b.example'>Post</a><a href='/bild.PNG'>Bild</a><a href='#x'>x</a><a href='klima.html'>noch einmal</a><a href='"), "next_url", F.lit("'>weiter</a>")
    )
    head = F.lit("<html><head><title> Seite </title><meta name='Description' content=' Text '><meta property='og:description' content='zweiter'><meta name='author' content='Amt'></head><body><nav><p>Ein Menü, das nicht zum Inhalt der Seite gehört</p><a href='/menue'>M</a></nav>")
    return d.select("document_id", "url", F.concat(head, "content", links, F.lit("</body></html>")).alias("html"))


@query("src_html", f"WITH {_PAGE_SQL} SELECT document_id, regexp_extract(url, '^(.*/)[^/]*$', 1) || 'klima.html' AS href, 'Klima hier' AS anchor FROM link UNION ALL SELECT document_id, next_url, 'weiter' FROM link WHERE next_url <> regexp_extract(url, '^(.*/)[^/]*$', 1) || 'klima.html'")
def src_html(spark, sf):
    """Links of every page: absolute, each once, without fragments, assets and other schemes."""
    p = html.parse(_pages(spark, sf), "document_id", "html", "url")
    return p.select("document_id", F.explode("links").alias("l")).select("document_id", "l.href", "l.anchor")


@query("udtf_parse", f"WITH {_PAGE_SQL} SELECT document_id, order_index, segment_type, text, heading_context FROM parsed")
def udtf_parse(spark, sf):
    """Segments of every page with the heading above them; those under 30 characters and those of menus are left out."""
    p = html.parse(_pages(spark, sf), "document_id", "html", "url")
    return p.select("document_id", F.explode("segments").alias("s")).select("document_id", "s.*")


@query("fn_meta_map", f"WITH {_PAGE_SQL} SELECT document_id, 'Seite' AS title, 'Text' AS description, 'Amt' AS author, 2 AS n_meta FROM link")
def fn_meta_map(spark, sf):
    """Metadata of every page under their common names, the first of each."""
    p = html.parse(_pages(spark, sf), "document_id", "html", "url")
    return p.select("document_id", "title", F.col("meta")["description"].alias("description"), F.col("meta")["author"].alias("author"), F.size("meta").alias("n_meta"))


@query("gr_links", f"WITH {_PAGE_SQL}, t AS (SELECT url, min(document_id) AS dst FROM page GROUP BY 1) SELECT DISTINCT document_id AS src, dst FROM link l JOIN t ON l.next_url = t.url WHERE dst <> document_id")
def gr_links(spark, sf):
    """Links between documents: the hyperlinks of the pages, canonical, resolved to the documents known under them."""
    pages = stage_table(_pages(spark, sf), "pages")
    p = html.parse(pages, "document_id", "html", "url").select("document_id", F.explode("links.href").alias("href"))
    links = p.select("document_id", urls.canonical(F.col("href")).alias("url")).filter("url <> ''").distinct()
    known = pages.select("document_id", urls.canonical(F.col("url")).alias("url_canonical"))
    return joins.resolve_urls(links, known, "url").filter("target is not null and target <> document_id").select(F.col("document_id").alias("src"), F.col("target").alias("dst")).distinct()


def offline_page(url: str):
    """A fetcher without a network: councils' papers are gone, reports answer at the third attempt, bilances never."""
    if "beschluss" in url:
        return 404, None, None, None
    if "bilanz" in url:
        return 503, None, None, 0.0
    if "bericht" in url:
        _asked[url] = _asked.get(url, 0) + 1
        if _asked[url] % 3:
            return 500, None, None, None
    return 200, "text/html", f"<html>{url}</html>".encode(), None


_asked: dict[str, int] = {}
_FETCHED = "CASE WHEN contains(url, 'beschluss') THEN 404 WHEN contains(url, 'bilanz') THEN 503 ELSE 200 END"
_URL_SQL = f"u AS (SELECT DISTINCT url_canonical AS url FROM documents_raw WHERE url_canonical IS NOT NULL), f AS (SELECT url, {_FETCHED} AS status FROM u)"
_NO_WAIT = lambda seconds: None


@query("src_http", f"WITH {_URL_SQL} SELECT url, status, CASE WHEN status = 200 THEN length(url) + 13 END AS n_bytes, CASE WHEN status <> 200 THEN 'http ' || status END AS error FROM f")
def src_http(spark, sf):
    """Answers to every URL, the hosts spread over the tasks."""
    got = fetch.fetch(table(spark, sf, "documents_raw"), "url_canonical", offline_page, sleep=_NO_WAIT)
    return got.select("url", "status", F.octet_length("body").alias("n_bytes"), "error")


@query("src_http_async", f"WITH {_URL_SQL} SELECT url, status, CASE WHEN status = 200 THEN 'text/html' END AS content_type FROM f")
def src_http_async(spark, sf):
    """The same, many at a time with a limit for each host."""
    return fetch.fetch_together(table(spark, sf, "documents_raw"), "url_canonical", offline_page, sleep=_NO_WAIT).select("url", "status", "content_type")


@query("src_retry", f"WITH {_URL_SQL} SELECT url, status, CASE WHEN status = 404 THEN 1 WHEN status = 503 OR contains(url, 'bericht') THEN 3 ELSE 1 END AS tries FROM f")
def src_retry(spark, sf):
    """Attempts that each URL took: one where the answer is final, three where the server fails."""
    return fetch.fetch(table(spark, sf, "documents_raw"), "url_canonical", offline_page, sleep=_NO_WAIT).select("url", "status", "tries")


@query("src_cache", f"WITH {_URL_SQL} SELECT url, CASE WHEN contains(url, 'stellt') THEN 304 ELSE status END AS status, contains(url, 'stellt') AS known FROM f")
def src_cache(spark, sf):
    """Fetches only what a cache lacks."""
    r = table(spark, sf, "documents_raw")
    kept = [F.lit(304).alias("status"), F.lit("text/html").alias("content_type"), F.lit(b"").alias("body"), F.lit(None).cast("string").alias("error")]
    cache = r.filter("url_canonical like '%stellt%'").select(F.col("url_canonical").alias("url"), *kept).dropDuplicates(["url"])
    return fetch.cached(r, "url_canonical", cache, offline_page, sleep=_NO_WAIT).select("url", "status", (F.col("tries") == 0).alias("known"))


SETTINGS = [("chunk_size", "600"), ("chunk_overlap", "60"), ("embed_batch", "64"), ("top_k", "3"), ("communities", "50"), ("critic_loops", "3"), ("fetch_tries", "5"), ("fetch_delay_s", "0.5"), ("fetch_at_once", "100"), ("fetch_per_host", "4"), ("fetch_most_bytes", "209715200")]


@query("src_api_config", cases_sql(SETTINGS, "name, value"))
def src_api_config(spark, sf):
    """Settings with three of them overridden by the environment."""
    c = Config.from_environment({"LODESTRATA_TOP_K": "3", "LODESTRATA_FETCH_TRIES": "5", "LODESTRATA_FETCH_DELAY_S": "0.5", "OTHER_TOP_K": "9"})
    return cases(spark, [(k, str(v)) for k, v in vars(c).items()], "name string, value string")


def offline_wikitext(title: str):
    return 200, "text/plain", f"Vorwort [[Anderes]]\n== Orte ==\n* [[{title}|Ort]] [[Datei:x.png]]\n* [[{title}]]\n== Ende ==\n[[Schluss]]{'x' * 40 * len(title)}".encode(), None


@query("src_wiki_fetch", """WITH t AS (SELECT DISTINCT landkreis AS title FROM municipalities WHERE landkreis IS NOT NULL)
SELECT title, CASE WHEN starts_with(title, 'Landkreis A') THEN 5 WHEN 87 + 42 * length(title) >= 1000 THEN 87 + 42 * length(title) END AS n FROM t""")
def src_wiki_fetch(spark, sf):
    """Lengths of list pages: some are cached, those that stay under 1,000 characters don't come."""
    m = table(spark, sf, "municipalities").select(F.col("landkreis").alias("title"))
    cache = m.filter("title like 'Landkreis A%'").distinct().withColumn("wikitext", F.lit("alter"))
    return wiki.list_pages(m, "title", cache, offline_wikitext, sleep=_NO_WAIT).select("title", F.char_length("wikitext").alias("n"))


@query("src_wiki_section", "SELECT name AS title FROM municipalities WHERE name NOT LIKE '%:%' GROUP BY 1")
def src_wiki_section(spark, sf):
    """Titles read back from a list page."""
    m = table(spark, sf, "municipalities").select("name").filter("name is not null and name not like '%:%'").distinct()
    page = m.agg(F.concat(F.lit("Vorwort [[Anderes]]\n== Orte ==\n"), F.array_join(F.transform(F.sort_array(F.collect_list("name")), lambda n: F.concat(F.lit("* [["), n, F.lit("|Ort]] [[Datei:x.png]]"))), "\n"), F.lit("\n== Ende ==\n[[Schluss]]")).alias("t")).withColumn("page", F.lit(1))
    return wiki.entries(page, "page", "t", "Orte").select("title")


def offline_reply(titles: list[str]) -> str:
    """Pages of a list of titles; titles of even length lead to another, those with 'burg' are missing."""
    to = {t: t + " (Ort)" if len(t) % 2 == 0 else t for t in titles}
    pages = [{"title": p, "pageid": len(p), "qid": "Q" + hashlib.md5(p.encode()).hexdigest()[:6], "missing": "burg" in p} for p in to.values()]
    return json.dumps({"redirects": [{"from": a, "to": b} for a, b in to.items() if a != b], "pages": pages}, ensure_ascii=False)


@query("src_wiki_api", """WITH t AS (SELECT name, max(is_kreisfrei) AS city FROM municipalities WHERE name IS NOT NULL GROUP BY 1), p AS (SELECT name AS title, city, CASE WHEN length(name) % 2 = 0 THEN name || ' (Ort)' ELSE name END AS page FROM t)
SELECT page, 'Q' || substr(md5(page), 1, 6) AS qid, length(page) AS pageid, min_by(title, (-coalesce(city, -1), title)) AS title FROM p WHERE NOT contains(page, 'burg') GROUP BY ALL""")
def src_wiki_api(spark, sf):
    """One title for each item that a service knows, cities first; asked in batches, redirects followed."""
    m = table(spark, sf, "municipalities").filter("name is not null").groupBy(F.col("name").alias("title")).agg(F.max("is_kreisfrei").alias("city"))
    meta = wiki.page_meta(m, "title", offline_reply)
    return meta.join(m, "title").groupBy("page", "qid", "pageid").agg(F.min_by("title", F.struct(-F.coalesce("city", F.lit(-1)), "title")).alias("title"))


@query("src_sparql", """SELECT DISTINCT m.ags, m.name, CAST(m.population AS VARCHAR) AS population, n.areas FROM municipalities m
JOIN (SELECT ags, array_to_string(list_sort(list_distinct(list_filter([landkreis, regierungsbezirk, bundesland], lambda x: x IS NOT NULL))), '|') AS areas FROM municipalities) n ON m.ags = n.ags""")
def src_sparql(spark, sf):
    """Results of a query with optional parts, and all areas in which a place lies over any number of steps."""
    from ..operators import graph

    m = table(spark, sf, "municipalities")
    value = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("string").alias("value")))
    one = F.struct(value("ags").alias("ags"), value("name").alias("name"), value("population").alias("population"))
    replies = m.groupBy("landkreis").agg(F.to_json(F.struct(F.struct(F.collect_list(one).alias("bindings")).alias("results"))).alias("reply"))
    found = wiki.bindings(replies, "reply", ["ags", "name", "population"])
    # place -> district -> region -> land, each only where it is known
    levels = [F.concat(F.lit("0:"), "ags"), F.concat(F.lit("1:"), "ags", F.lit(":"), "landkreis"), F.concat(F.lit("2:"), "ags", F.lit(":"), "regierungsbezirk"), F.concat(F.lit("3:"), "ags", F.lit(":"), "bundesland")]
    chain = m.select(F.array_compact(F.array(*levels)).alias("c")).select(F.explode(F.transform(F.slice("c", 1, F.size("c") - 1), lambda x, i: F.struct(x.alias("node"), F.get("c", i + 1).alias("parent")))).alias("e")).select("e.*")
    up = graph.ancestors(chain).filter("node like '0:%'").select(F.expr("substring(node, 3)").alias("ags"), F.expr("substring_index(ancestor, ':', -1)").alias("area"))
    areas = up.groupBy("ags").agg(F.array_join(F.array_sort(F.collect_set("area")), "|").alias("areas"))
    return found.join(areas, "ags", "left").select("ags", "name", "population", F.coalesce("areas", F.lit("")).alias("areas"))


#: Replies of a model, and (entities, relations) that are read from them.
REPLIES = [
    ('{"entities":[{"name":"Amt","type":"Akteur"}],"relationships":[]}', "Amt", ""),
    ('```json\n{"entities":[{"name":"Netz","type":"Infrastruktur"},{"name":"Amt","type":"Akteur"}],"relationships":[{"source_entity":"Amt","relation_type":"BAUT","target_entity":"Netz"}]}\n```', "Netz,Amt", "Amt-BAUT-Netz"),
    ('Hier ist es: {"entities":[{"name":"Plan","type":"Dokument"}]} Ende.', "Plan", ""), ("keine Antwort", "", ""), ("", "", ""), (None, "", ""), ("{kaputt", "", ""), ('{"entities":"nein"}', "", ""),
    ('{"entities":[{"name":"","type":"Ort"},{"name":"X","type":"Unbekannt"},{"type":"Ort"}],"relationships":[{"source_entity":"A","relation_type":"mag","target_entity":"B"},{"source_entity":"A"}]}', "", "A-BEZIEHT_SICH_AUF-B"),
]


@query("fn_json_parse_kg", f"WITH {SEG_SQL} SELECT segment_id AS item, heading_context AS entities, heading_context || '-PLANT-' || segment_id AS relations FROM seg WHERE heading_context IS NOT NULL UNION ALL SELECT coalesce(item, '-'), entities, relations FROM {cases_sql(REPLIES, 'item, entities, relations')}")
def fn_json_parse_kg(spark, sf):
    """Replies in code fences about every heading, and given ones, good and bad."""
    s = segments(spark, sf, "heading_context", where="heading_context is not null")
    entity, relation = F.struct(F.col("heading_context").alias("name"), F.lit("Dokument").alias("type")), F.struct(F.col("heading_context").alias("source_entity"), F.lit("plant").alias("relation_type"), F.col("segment_id").alias("target_entity"))
    made = s.select(F.col("segment_id").alias("item"), F.concat(F.lit("```json\n"), F.to_json(F.struct(F.array(entity).alias("entities"), F.array(relation).alias("relationships"))), F.lit("\n```")).alias("reply"))
    given = cases(spark, REPLIES, "reply string, e string, r string").select(F.coalesce("reply", F.lit("-")).alias("item"), "reply")
    kg = made.unionByName(given).select("item", offline.parse_reply(F.col("reply")).alias("kg"))
    relations = F.transform("kg.relationships", lambda r: F.concat_ws("-", r["source_entity"], r["relation_type"], r["target_entity"]))
    return kg.select("item", F.array_join("kg.entities.name", ",").alias("entities"), F.array_join(relations, ",").alias("relations"))
