"""Pages as segments, links and metadata."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit, urlunsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tags whose text is left out, tags that make segments, and the names of metadata.
DROPPED = {"script", "style", "noscript", "svg", "nav", "footer", "aside"}
SEGMENT_TAGS = {"h1": "heading", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading", "p": "paragraph", "li": "list_item"}
META = {
    "description": "description", "og:description": "description", "og:title": "og_title", "article:published_time": "date", "date": "date", "dcterms.date": "date",
    "dcterms.modified": "date_modified", "author": "author", "dcterms.creator": "author", "keywords": "keywords", "og:type": "og_type",
}
LEAST_CHARS = 30


_ASSET = re.compile(r"\.(?:jpe?g|png|gif|webp|svg|mp[34]|avi|mov|mkv|zip|rar|7z|tar|gz|css|js|woff2?|ttf|ico)(?:\?|$)", re.IGNORECASE)


def absolute(base: str, href: str) -> str | None:
    """Address of a link on a page, without fragment and doubled slashes; none for other schemes and assets."""
    if href.startswith(("#", "mailto:", "tel:", "javascript:")):
        return None
    try:
        url = urljoin(base, href).partition("#")[0]
        parts = urlsplit(url)
    except ValueError:
        return None
    if parts.scheme.lower() not in ("http", "https") or _ASSET.search(url):
        return None
    return urlunsplit(parts._replace(path=re.sub("/{2,}", "/", parts.path)))


class Page(HTMLParser):
    """Reads a page in one pass: segments of at least ``LEAST_CHARS`` characters in order, each with the headings above it, and its links, each once."""

    def __init__(self, base: str = ""):
        super().__init__(convert_charrefs=True)
        self.base = base
        self.title, self.meta, self.links, self.segments = "", {}, [], []
        self._skip, self._tag, self._text, self._path = 0, None, [], []
        self._in_title, self._href, self._anchor, self._seen = False, None, [], set()

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in DROPPED:
            self._skip += 1
        elif tag == "title":
            self._in_title = True
        elif tag == "meta":
            key = META.get((a.get("name") or a.get("property") or "").lower().strip())
            if key and a.get("content"):
                if a["content"].strip():
                    self.meta.setdefault(key, a["content"].strip())
        elif tag == "a" and a.get("href") and not self._skip:
            self._close_link()
            self._href, self._anchor = a["href"].strip(), []
        elif tag in SEGMENT_TAGS and not self._skip:
            self._close()
            self._tag, self._text = tag, []

    def handle_endtag(self, tag):
        if tag in DROPPED:
            self._skip = max(0, self._skip - 1)
        elif tag == "title":
            self._in_title = False
        elif tag == "a":
            self._close_link()
        elif tag == self._tag:
            self._close()

    def handle_data(self, data):
        if self._in_title:
            self.title += data
        elif not self._skip:
            if self._tag:
                self._text.append(data)
            if self._href is not None:
                self._anchor.append(data)

    def close(self):
        super().close()
        self._close()
        self._close_link()
        return self

    def _close(self):
        if self._tag is None:
            return
        text = re.sub(r"\s+", " ", "".join(self._text)).strip()
        tag, self._tag = self._tag, None
        kind = SEGMENT_TAGS[tag]
        if len(text) < LEAST_CHARS:
            return
        context = ""
        if kind == "heading":
            level = int(tag[1])
            self._path = [h for h in self._path if h[0] < level] + [(level, text)]
        else:
            context = " > ".join(t for _, t in self._path)
        self.segments.append((kind, text, context or None))

    def _close_link(self):
        if self._href is not None:
            anchor = re.sub(r"\s+", " ", "".join(self._anchor)).strip()
            url, self._href = absolute(self.base, self._href), None
            if url and url not in self._seen:
                self._seen.add(url)
                self.links.append((url, anchor[:300]))


def read(html: str | None, base: str | None = None) -> Page:
    page = Page(base or "")
    page.feed(html or "")
    return page.close()


SCHEMA = "title string, meta map<string,string>, segments array<struct<order_index:int,segment_type:string,text:string,heading_context:string>>, links array<struct<href:string,anchor:string>>"


def parse(df: DataFrame, key: str, html: str, base: str | None = None) -> DataFrame:
    """(key, title, meta, segments, links) of each page; null pages have no segments. ``base`` names the column of the pages' addresses."""
    key_type = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            pages = [read(x, b) for x, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([p.title.strip() for p in pages], pa.string()),
                    pa.array([list(p.meta.items()) for p in pages], pa.map_(pa.string(), pa.string())),
                    pa.array(
                        [[{"order_index": i, "segment_type": k, "text": t, "heading_context": h} for i, (k, t, h) in enumerate(p.segments)] for p in pages],
                        pa.list_(pa.struct([("order_index", pa.int32()), ("segment_type", pa.string()), ("text", pa.string()), ("heading_context", pa.string())])),
                    ),
                    pa.array([[{"href": a, "anchor": b} for a, b in p.links] for p in pages], pa.list_(pa.struct([("href", pa.string()), ("anchor", pa.string())]))),
                ],
                names=[key, "title", "meta", "segments", "links"],
            )

    return df.select(key, html, (F.col(base) if base else F.lit(None).cast("string")).alias("_base")).mapInArrow(run, f"`{key}` {key_type}, {SCHEMA}")
