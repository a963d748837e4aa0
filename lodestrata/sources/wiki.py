"""List pages in wiki markup, page metadata in batches, and bindings of structured queries."""

from __future__ import annotations

import hashlib
import time

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from . import fetch


def section(text: Column, heading: str) -> Column:
    """Text under a heading of the second level, up to the next such heading."""
    return F.regexp_extract(text, rf"(?s)(?:^|\n)==\s*\Q{heading}\E\s*==[^\n]*\n(.*?)(?=\n==[^=]|$)", 1)


def entries(df: DataFrame, key: str, text: str, heading: str) -> DataFrame:
    """(key, at, title, label) of the linked titles of a section, the first of each title; files, anchors and list pages are left out."""
    links = F.regexp_extract_all(section(F.col(text), heading), F.lit(r"\[\[([^\[\]]+)\]\]"), F.lit(1))
    each = df.select(key, F.posexplode(links).alias("at", "link"))
    title = F.trim(F.split_part("link", F.lit("|"), F.lit(1)))
    label = F.when(F.col("link").contains("|"), F.trim(F.split_part("link", F.lit("|"), F.lit(2)))).otherwise(title)
    named = each.select(key, "at", title.alias("title"), label.alias("label")).filter(~F.col("title").rlike(r"[:#]|^Liste "))
    first = named.groupBy(key, "title").agg(F.min(F.struct("at", "label")).alias("f"))
    return first.select(key, F.col("f.at").alias("at"), "title", F.col("f.label").alias("label"))


def list_pages(titles: DataFrame, title: str, cache: DataFrame, fetcher, tries: int = 10, least: int = 1000, sleep=time.sleep) -> DataFrame:
    """(title, wikitext) of list pages: from ``cache`` (title, wikitext), else fetched in up to ``tries`` attempts; null where none gave ``least`` characters."""
    wanted = titles.select(F.col(title).alias("title")).filter("title is not null").distinct()
    known = cache.join(wanted, "title", "left_semi").select("title", "wikitext")
    missing = wanted.join(cache.select("title"), "title", "left_anti")
    got = fetch.fetch(missing, "title", fetcher, Config(fetch_tries=tries), lambda b: b is not None and len(b.decode("utf-8", "replace")) >= least, sleep)
    return known.unionByName(got.select(F.col("url").alias("title"), F.decode("body", "utf-8").alias("wikitext")))


PAGE_REPLY = "struct<redirects:array<struct<`from`:string,`to`:string>>,pages:array<struct<title:string,pageid:long,qid:string,missing:boolean>>>"


def page_meta(titles: DataFrame, title: str, ask, batch: int = 50) -> DataFrame:
    """(title, page, pageid, qid) of each title: asked ``batch`` at a time, redirects followed, missing pages left out.

    ``ask`` gives the JSON reply to a list of titles; each distinct list is asked once a task and known by its hash.
    """

    def run(batches):
        replies: dict[str, str] = {}
        for rows in batches:
            wanted = rows.column(0).to_pylist()
            for at in range(0, len(wanted), batch):
                part = wanted[at : at + batch]
                key = hashlib.sha1("|".join(part).encode()).hexdigest()
                if key not in replies:
                    replies[key] = ask(part)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.list_(pa.string())), pa.array([replies[key]])], names=["titles", "reply"])

    own = titles.select(F.col(title).alias("title")).filter("title is not null").distinct()
    got = own.mapInArrow(run, "titles array<string>, reply string").select("titles", F.from_json("reply", PAGE_REPLY).alias("r"))
    asked = got.select(F.explode("titles").alias("title"), F.map_from_entries(F.transform(F.coalesce("r.redirects", F.array()), lambda x: F.struct(x["from"], x["to"]))).alias("to"), F.col("r.pages").alias("pages"))
    to = asked.select("title", F.coalesce(F.col("to")[F.col("title")], F.col("title")).alias("page"), "pages")
    page = F.element_at(F.filter("pages", lambda x: x["title"] == F.col("page")), 1)
    return to.select("title", "page", page.alias("p")).filter("p is not null and not coalesce(p.missing, false)").select("title", "page", "p.pageid", "p.qid")


def bindings(df: DataFrame, reply: str, names: list[str]) -> DataFrame:
    """A column for each name, a row for each distinct binding of SPARQL results in JSON; optional variables that aren't bound are null."""
    one = ",".join(f"`{n}`:struct<value:string>" for n in names)
    rows = df.select(F.explode(F.from_json(reply, f"struct<results:struct<bindings:array<struct<{one}>>>>")["results"]["bindings"]).alias("b"))
    return rows.select(*[F.col("b")[n]["value"].alias(n) for n in names]).distinct()
