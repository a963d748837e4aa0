"""Fetching as a batched source: any fetcher, with retries, a delay for each host, and a cache of what came."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config

#: A fetcher gives (status, content type, body, seconds the server asks to wait or None).
Fetcher = Callable[[str], tuple[int, str | None, bytes | None, float | None]]


def over_http(url: str) -> tuple[int, str | None, bytes | None, float | None]:
    """Plain HTTP GET with a size cap."""
    from urllib.error import HTTPError
    from urllib.request import urlopen

    try:
        with urlopen(url, timeout=20) as r:
            return r.status, r.headers.get("content-type"), r.read(Config().fetch_most_bytes + 1), None
    except HTTPError as e:
        wait = e.headers.get("retry-after") if e.headers else None
        return e.code, None, None, float(wait) if wait and wait.isdigit() else None


def with_retries(fetcher: Fetcher, url: str, tries: int, sleep: Callable[[float], None] = time.sleep, accept: Callable[[bytes | None], bool] | None = None) -> tuple[int, str | None, bytes | None, str | None, int]:
    """(status, content type, body, error, tries): tried again after server errors, failures and bodies not accepted, waiting as asked or twice as long each time."""
    error = None
    status, kind, body = 0, None, None
    for i in range(tries):
        wait = None
        try:
            status, kind, body, wait = fetcher(url)
            error = None if status < 400 else f"http {status}"
            if error is None and accept is not None and not accept(body):
                error = "not accepted"
            elif status < 500 and status != 429:
                return status, kind, body, error, i + 1
        except Exception as e:  # noqa: BLE001
            status, kind, body, error = 0, None, None, str(e)[:500]
        if i + 1 < tries:
            sleep(wait if wait is not None else 0.5 * 2**i)
    return status, kind, None if error == "not accepted" else body, error, tries


SCHEMA = "url string, status int, content_type string, body binary, error string, tries int"
_KINDS = [pa.string(), pa.int32(), pa.string(), pa.binary(), pa.string(), pa.int32()]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * len(_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, _KINDS)], names=[x.split()[0] for x in SCHEMA.split(", ")])


def _placed(urls: DataFrame, url: str) -> DataFrame:
    own = urls.filter(F.col(url).isNotNull()).select(F.col(url).alias("url")).distinct()
    return own.withColumn("host", F.regexp_extract("url", r"^[^:]+://([^/?#]+)", 1)).repartition("host").sortWithinPartitions("host", "url").select("url")


def fetch(urls: DataFrame, url: str, fetcher: Fetcher = over_http, config: Config = Config(), accept: Callable[[bytes | None], bool] | None = None, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``SCHEMA`` of each distinct URL. A host's URLs are in one task, one after the other, so its delay holds without coordination."""

    def run(batches):
        last: dict[str, float] = {}
        for batch in batches:
            out = []
            for u in batch.column(0).to_pylist():
                host = urlsplit(u).netloc
                wait = last.get(host, 0.0) + config.fetch_delay_s - time.monotonic() if host in last else 0
                if wait > 0 and fetcher is over_http:
                    time.sleep(wait)
                out.append((u, *with_retries(fetcher, u, config.fetch_tries, sleep, accept)))
                last[host] = time.monotonic()
            yield _rows(out)

    return _placed(urls, url).mapInArrow(run, SCHEMA)


def fetch_together(urls: DataFrame, url: str, fetcher: Fetcher = over_http, config: Config = Config(), sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """As ``fetch``, many at a time: at most ``fetch_at_once`` in a task, and ``fetch_per_host`` of one host, which is in one task."""

    def run(batches):
        hosts: dict[str, threading.Semaphore] = {}

        def one(u: str) -> tuple:
            with hosts[urlsplit(u).netloc]:
                return (u, *with_retries(fetcher, u, config.fetch_tries, sleep))

        with ThreadPoolExecutor(config.fetch_at_once) as pool:
            for batch in batches:
                wanted = batch.column(0).to_pylist()
                for u in wanted:
                    hosts.setdefault(urlsplit(u).netloc, threading.Semaphore(config.fetch_per_host))
                yield _rows(list(pool.map(one, wanted)))

    return _placed(urls, url).mapInArrow(run, SCHEMA)


def cached(urls: DataFrame, url: str, cache: DataFrame, fetcher: Fetcher = over_http, config: Config = Config(), sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """As ``fetch``, but what ``cache`` (``SCHEMA``) has isn't fetched again."""
    wanted = urls.select(F.col(url).alias("url")).filter("url is not null").distinct()
    missing = wanted.join(cache.select("url"), "url", "left_anti")
    return cache.join(wanted, "url", "left_semi").select("url", "status", "content_type", "body", "error", F.lit(0).alias("tries")).unionByName(fetch(missing, "url", fetcher, config, sleep=sleep))
