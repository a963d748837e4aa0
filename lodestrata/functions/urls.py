"""Scalar functions on URLs, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon, text


def scheme(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def host(c: Column) -> Column:
    """Lower-cased host without port, empty where there is none."""
    return F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def valid(c: Column) -> Column:
    return scheme(c).isin("http", "https") & (host(c) != "")


def depth(c: Column) -> Column:
    """Number of path steps."""
    return F.size(F.filter(F.split(F.regexp_extract(c, r"^[^:]+://[^/?#]*([^?#]*)", 1), "/"), lambda x: x != ""))


def norm_domain(c: Column, keep_www: bool = False) -> Column:
    """Domain without scheme, port, leading ``www.`` and final dots."""
    d = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    d = F.when(F.startswith(d, F.lit("//")), F.concat(F.lit("http:"), d)).otherwise(d)
    d = F.when(d.contains("://"), F.regexp_extract(d, r"://([^/?#]*)", 1)).otherwise(d)
    d = F.regexp_replace(d, r":.*$", "")
    return F.rtrim(d if keep_www else F.regexp_replace(d, r"^www\.", ""), F.lit("."))


def allowed_domains(raw: Column, homepage: Column) -> Column:
    """Distinct sorted domains of a piped list, or the homepage's where the list has none."""
    listed = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), r"\|"), lambda d: norm_domain(d, keep_www=True)), lambda d: d != "")))
    own = host(homepage)
    return F.when(F.size(listed) > 0, listed).when(own != "", F.array(own)).otherwise(F.array().cast("array<string>"))


def priority(url: Column, anchor: Column) -> Column:
    """Frontier priority by file type, council systems and word lists in URL and anchor."""
    u, a = F.lower(F.coalesce(url, F.lit(""))), F.lower(F.coalesce(anchor, F.lit("")))
    council = F.lit(False)
    for mark in lexicon.COUNCIL_MARKS:
        council = council | u.contains(mark)
    points = lambda cond, n: F.when(cond, F.lit(n)).otherwise(F.lit(0))
    positive, negative = lexicon.java(lexicon.POSITIVE), lexicon.java(lexicon.NEGATIVE)
    return F.lit(10) + points(u.contains(".pdf"), 300) + points(council, 200) + points(u.rlike(positive), 150) + points(a.rlike(positive), 100) - points(u.rlike(negative), 50) - points(a.rlike(negative), 20)


def _folded_path(path: Column) -> Column:
    """Path with its dot segments resolved and without a slash at its end."""
    steps = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    kept = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s != "..", F.array_append(acc, s)).otherwise(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def _decoded(c: Column) -> Column:
    """A part of a query with its escapes resolved; left alone where they are malformed."""
    return F.coalesce(F.try_url_decode(c), c)


def _encoded(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical(c: Column) -> Column:
    """Canonical form of an http(s) URL, empty for any other: host lower-cased and without default port, path folded,
    tracking parameters dropped, parameters sorted by name and value and encoded anew, no fragment."""
    u = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"[\t\r\n]", "")
    sch = scheme(u)
    net = F.lower(F.trim(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)))
    port = F.when(sch == "http", "80").otherwise("443")
    net = F.when(net.rlike(r"^(?:\[[^\]]+\]|[^:]+):\d+$") & (F.substring_index(net, ":", -1) == port), F.regexp_replace(net, r":\d+$", "")).otherwise(net)
    path = F.regexp_extract(u, r"^[^:]+://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    name = lambda p: _decoded(F.substring_index(p, "=", 1))
    value = lambda p: _decoded(F.when(p.contains("="), F.regexp_extract(p, r"(?s)=(.*)$", 1)).otherwise(F.lit("")))
    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(F.lower(name(p)).alias("k"), value(p).alias("v"), name(p).alias("name")))
    dropped = lambda k: k.isin(lexicon.DROPPED_PARAMETERS) | F.exists(F.array(*[F.lit(x) for x in lexicon.DROPPED_PREFIXES]), lambda x: F.startswith(k, x))
    kept = F.transform(F.array_sort(F.filter(pairs, lambda p: ~dropped(p["k"]))), lambda p: F.concat(_encoded(p["name"]), F.lit("="), _encoded(p["v"])))
    out = F.concat(sch, F.lit("://"), net, _folded_path(path), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    return F.when(sch.isin("http", "https") & (net != ""), out).otherwise(F.lit(""))


def is_trap(c: Column, depth: Column, longest: int = 2048, most_params: int = 60, most_repeats: int = 5, most_pages: int = 20) -> Column:
    """Whether a URL leads into a crawler trap: too long, a blocked file type or path, too many or repeated parameters, deep pagination."""
    u = F.coalesce(c, F.lit(""))
    path = F.lower(F.substring_index(u, "?", 1))
    query = F.when(u.contains("?"), F.lower(F.regexp_extract(u, r"\?(.*)$", 1))).otherwise(F.lit(""))
    extension = F.regexp_extract(path, r"\.([a-z0-9]{1,6})$", 1)
    blocked = F.lit(False)
    for p in lexicon.TRAP_PATHS:
        blocked = blocked | path.contains(p)
    keys = F.filter(F.transform(F.split(query, "[&;]"), lambda p: F.substring_index(p, "=", 1)), lambda k: k != "")
    params = F.size(F.split(query, "[&;]"))
    repeated = F.exists(F.array_distinct(keys), lambda k: F.size(F.filter(keys, lambda x: x == k)) > most_repeats)
    paged = F.lit(False)
    for p in lexicon.PAGINATION:
        paged = paged | text.ascii_lower(u).contains(p)
    number = F.regexp_extract(u, r"(?i)(?:page=|offset=|start=|/page/)(\d{1,9})", 1).try_cast("int")
    return (
        (u == "") | (F.char_length(u) > longest) | extension.isin(lexicon.TRAP_EXTENSIONS) | blocked
        | ((query != "") & ((params > most_params) | repeated))
        | (paged & (F.coalesce(number > most_pages, F.lit(False)) | (depth > most_pages)))
    )


def _undotted(path: Column) -> Column:
    """Path without dot segments; a slash at its end stays, never above the root."""
    steps = F.split(path, "/", -1)
    kept = F.aggregate(
        F.slice(steps, 2, F.greatest(F.size(steps) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.array_append(acc, x)),
    )
    ends = F.element_at(steps, -1).isin(".", "..") & (F.size(kept) > 0)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(ends, F.lit("/")).otherwise(F.lit("")))


def join(base: Column, href: Column) -> Column:
    """Absolute URL of a reference found on a page: absolute, of the same scheme, of the root, of the query or fragment alone, or relative with dot segments."""
    h = F.coalesce(href, F.lit(""))
    origin = F.regexp_extract(base, r"^([^:]+://[^/?#]*)", 1)
    own_path = F.regexp_extract(base, r"^[^:]+://[^/?#]*([^?#]*)", 1)
    own_query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    path, rest = F.regexp_extract(h, r"^([^?#]*)", 1), F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(own_path, r"^/?(.*/)?", 1))
    return (
        F.when(h == "", base)
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(F.startswith(h, F.lit("//")), F.concat(scheme(base), F.lit(":"), h))
        .when(F.startswith(h, F.lit("/")), F.concat(origin, _undotted(path), rest))
        .when(F.startswith(h, F.lit("?")), F.concat(origin, own_path, h))
        .when(F.startswith(h, F.lit("#")), F.concat(origin, own_path, own_query, h))
        .otherwise(F.concat(origin, _undotted(F.concat(folder, path)), rest))
    )


def http_norm(c: Column) -> Column:
    """URL with https for a missing scheme, empty where it isn't usable."""
    u = F.trim(F.coalesce(c, F.lit("")))
    u = F.when(F.startswith(u, F.lit("//")), F.concat(F.lit("https:"), u)).otherwise(u)
    return F.when(valid(u), u).otherwise(F.lit(""))
