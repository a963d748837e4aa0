"""Main body of web pages, without what frames it.

The pages of a host are laid out as streams of tokens (words with digits masked,
and a mark at every segment's end). A suffix array of each stream is built by
prefix doubling until all suffixes are told apart, with the longest common
prefixes of its neighbours; from it comes, for each position, the longest run of
tokens that another page repeats. Long runs cover boilerplate, and each segment
gets the share of its tokens that they cover.

A stream holds about ``PAGES`` pages of a host, so no host is ever gathered
whole. What decides by the number of pages is counted over the whole host:
winnowed parts (of every run of ``RUN`` tokens at least one part is chosen, the
same wherever it stands), lines and whole segments are hashed, and the hashes of
all streams of a host are added up, with the counts of a stream made before the
shuffle. A run on three pages of a host is found wherever its pages lie.

Coverage alone can't judge pages of small hosts, nor a main text that repeats
itself, so a logistic model weighs the coverages together with the segment's
form, its place on the page, and its words; it is fitted on a bounded sample of
labelled segments. Without labels of both kinds coverage alone decides.

Null texts and segments without letters or digits count as frame; duplicate
rows count once; a null host has streams of its own.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_table, stage_table
from . import words

#: Pages of a host in one stream.
PAGES = 200
#: Labelled segments used at most for fitting, those with the smallest hash.
MAX_LABELLED = 20_000
#: A long run, the part of it that is hashed, and the window of such parts of which one is chosen.
RUN, PART = 8, 6
WINDOW = RUN - PART + 1
#: A line inside a main segment is frame if it stands on so many pages of the host.
FRAME_PAGES = 4
#: Buckets of the words' weights.
BUCKETS = 1 << 14
N_DENSE = 24
_NONE = np.iinfo(np.uint64).max


def suffix_array(token: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(positions in the order of their suffixes; ranks by the first 1, 2, 4, ... tokens), by prefix doubling to the end."""
    n = len(token)
    rank = np.unique(token, return_inverse=True)[1].astype(np.int64)
    levels, have = [rank], 1
    order = np.argsort(rank, kind="stable")
    while n and rank.max() < n - 1:
        second = np.zeros(n, dtype=np.int64)
        second[: max(n - have, 0)] = rank[have:] + 1
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        k = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[False], k[1:] != k[:-1]]))
        levels.append(rank)
        have *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in order; 0 for the first."""
    n = len(order)
    lcp = np.zeros(n, dtype=np.int64)
    i, j = order[:-1].copy(), order[1:].copy()
    for level in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((i < n) & (j < n))
        same = inside[levels[level][i[inside]] == levels[level][j[inside]]]
        lcp[1:][same] += 1 << level
        i[same] += 1 << level
        j[same] += 1 << level
    return lcp


def longest_elsewhere(token: np.ndarray, page: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest run from it that stands on another page too."""
    n = len(token)
    if not n:
        return np.zeros(0, dtype=np.int64)
    order, levels = suffix_array(token)
    lcp = common_prefixes(order, levels)
    out = np.zeros(n, dtype=np.int64)
    for sa, shared in ((order, lcp), (order[::-1], np.concatenate([[0], lcp[:0:-1]]))):
        # the nearest suffix of another page before it: the least prefix since the page changed
        p = page[sa]
        streak = np.cumsum(np.concatenate([[True], p[1:] != p[:-1]]))
        big = np.int64(n + 1)
        least = np.minimum.accumulate(shared - streak * big) + streak * big
        out[sa] = np.maximum(out[sa], least)
    return out


def covered(start: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n tokens lie in a run that begins at ``start`` and has ``length`` tokens."""
    delta = np.zeros(n + 1, dtype=np.int32)
    np.add.at(delta, start, 1)
    np.add.at(delta, np.minimum(start + length, n), -1)
    return np.cumsum(delta)[:n] > 0


def winnowed(token: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the chosen parts: the least hash of each window of ``WINDOW`` neighbouring parts."""
    n = len(token) - PART + 1
    if n < 1:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(PART):
        h = h * words.K1 + token[j : j + n]
    h = words.mix(h)
    # no part lies on two pages or holds a page's end, which differs from stream to stream
    h[(page[:n] != page[PART - 1 :]) | (token[PART - 1 :] >> np.uint64(32) > 0)] = _NONE
    edge = np.full(WINDOW - 1, _NONE, dtype=np.uint64)  # as between two pages, so that a page's parts don't depend on its neighbours
    padded = np.concatenate([edge, h, edge])
    at = np.unique(np.lib.stride_tricks.sliding_window_view(padded, WINDOW).argmin(axis=1) + np.arange(len(padded) - WINDOW + 1)) - len(edge)
    at = at[(at >= 0) & (at < n)]
    at = at[h[at] != _NONE]
    return at, h[at]


def long_runs(at: np.ndarray, hit: np.ndarray, page: np.ndarray, n: int) -> np.ndarray:
    """Which of n tokens lie in repeated parts, or between two of one page that are neighbours."""
    at = at[hit]
    if not len(at):
        return np.zeros(n, dtype=bool)
    joined = np.append((np.diff(at) <= PART + WINDOW) & (page[at[1:]] == page[at[:-1]]), False)
    return covered(at, np.where(joined, np.append(np.diff(at), 0), PART), n)


def page_counts(key: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, on how many pages each stands)."""
    order = np.lexsort((page, key))
    k, p = key[order], page[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (p[1:] != p[:-1])
    return np.unique(k[new], return_counts=True)


def stream(page: np.ndarray, texts: list[str]) -> dict[str, np.ndarray]:
    """Tokens of segments that come page by page, in order: ``token`` (32 bits), its ``segment`` and line, ``is_mark``, and the segments' words."""
    n = len(texts)
    plain = [re.sub(r"\d+", "#", t.lower()) for t in texts]
    word, begin, _, bounds = words.word_hashes(plain, extra="#")
    n_words = np.diff(bounds)
    where = bounds[1:] + np.arange(n)
    token = np.zeros(len(word) + n, dtype=np.uint64)
    is_mark = np.zeros(len(token), dtype=bool)
    is_mark[where] = True
    token[~is_mark] = word >> np.uint64(32)
    token[where] = np.uint64(1)
    last_of_page = np.concatenate([page[1:] != page[:-1], [True]]) if n else np.zeros(0, dtype=bool)
    token[where[last_of_page]] = np.arange(1, last_of_page.sum() + 1, dtype=np.uint64) + np.uint64(1 << 32)
    segment = np.repeat(np.arange(n), n_words + 1)
    code, starts = words.codes(plain)
    breaks = np.cumsum(code == 10)
    line = np.zeros(len(token), dtype=np.int64)
    if len(word):
        line[~is_mark] = breaks[begin] - np.where(starts[:-1] > 0, breaks[np.maximum(starts[:-1] - 1, 0)], 0)[segment[~is_mark]]
    return {"token": token, "segment": segment, "line": line, "is_mark": is_mark, "word": word, "n_words": n_words, "bounds": bounds}


def form_features(page: np.ndarray, texts: list[str], kind: list[str], no_context: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Dense features of form and place of each segment; those of repetition are left 0."""
    n = len(texts)
    dense = np.zeros((n, N_DENSE), dtype=np.float32)
    if not n:
        return dense
    first = np.concatenate([[True], page[1:] != page[:-1]])
    begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    ends = np.append(np.flatnonzero(first)[1:], n)
    end = ends[np.cumsum(first) - 1]
    top, bottom = np.arange(n) - begin, end - 1 - np.arange(n)
    kind = np.array([k or "" for k in kind])
    heading = kind == "heading"
    heads = np.cumsum(heading)
    closes = np.array([t.rstrip()[-1:] in ".!?;:" and t.rstrip() != "" for t in texts])
    prose = closes & (n_words >= 6)
    # prose before and after on the same page
    total = np.cumsum(prose)
    base = np.where(begin > 0, total[begin - 1], 0)
    before, after = total - base - prose, total[end - 1] - total
    dense[:, 7] = np.log1p(n_words)
    dense[:, 8] = closes
    dense[:, 9] = closes & (n_words >= 8)
    dense[:, 10] = heading
    dense[:, 11] = kind == "list_item"
    dense[:, 12] = no_context
    dense[:, 13] = np.minimum(top, 8) / 8
    dense[:, 14] = np.minimum(bottom, 8) / 8
    dense[:, 15] = heads - np.where(begin > 0, heads[begin - 1], 0) == 0
    dense[:, 16] = before == 0
    dense[:, 17] = after == 0
    dense[:, 18] = n_words >= 30
    dense[:, 19] = n_words == 0
    dense[:, 20] = (before > 0) & (after > 0)
    dense[:, 21] = 1.0
    return dense


def word_buckets(texts: list[str], word: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    bucket = (word % np.uint64(BUCKETS)).astype(np.uint16)
    out = []
    for i, t in enumerate(texts):
        signs = {hash_sign(c) for c in set(t) if not c.isalnum() and c not in " .,\n"}
        out.append(np.unique(bucket[bounds[i] : bounds[i + 1]]).tobytes() + np.array(sorted(signs), dtype=np.uint16).tobytes())
    return out


def hash_sign(c: str) -> int:
    return (ord(c) * 0x9E3779B1 >> 7) % BUCKETS


STREAM = (
    "host string, block int, parts int, host_pages long, item array<string>, doc array<long>, dense binary, buckets array<binary>,"
    " token binary, segment binary, line binary, page binary"
)
FEATURES = "item string, doc long, dense binary, buckets binary, frame_lines array<int>"


def _streams(df: DataFrame) -> DataFrame:
    """``STREAM``, one row for each stream, of the distinct rows of (item, doc, host, ord, kind, text, no_context); the texts are shuffled once.

    The staged table is bucketed as its rows lie, so that the counts come to the
    streams and no stream is moved again.
    """
    pages = df.select("host", "doc").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    pages = stage_table(pages.select(F.coalesce("host", F.lit("\u0000")).alias("host"), "host_pages", F.ceil(F.col("host_pages") / F.lit(PAGES)).cast("int").alias("parts")), "host_pages")
    n = pages.agg(F.sum("parts")).first()[0] or 1
    cols = ["item", "doc", "ord", "kind", "text", "no_context", "parts", "host_pages"]
    placed = df.withColumn("host", F.coalesce("host", F.lit("\u0000"))).join(pages, "host").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int"))
    # few streams to a task, by their number, as their cost is in the work and not in the bytes
    partitions = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // 4)

    def block(table: pa.Table) -> pa.Table:
        host, number, parts, host_pages = (table.column(c)[0].as_py() for c in ("host", "block", "parts", "host_pages"))
        table = table.sort_by([("doc", "ascending"), ("ord", "ascending"), ("item", "ascending")])
        item = table.column("item").to_numpy()
        table = table.filter(pa.array(np.concatenate([[True], item[1:] != item[:-1]])))
        page = np.unique(table.column("doc").to_numpy(), return_inverse=True)[1]
        texts = [t or "" for t in table.column("text").to_pylist()]
        made = stream(page, texts)
        dense = form_features(page, texts, table.column("kind").to_pylist(), table.column("no_context").to_numpy(), made["n_words"])
        row = {
            "host": host, "block": number, "parts": parts, "host_pages": host_pages, "item": table.column("item").to_pylist(), "doc": table.column("doc").to_pylist(),
            "dense": dense.astype(np.float16).tobytes(), "buckets": word_buckets(texts, made["word"], made["bounds"]), "token": made["token"].tobytes(), "segment": made["segment"].astype(np.int32).tobytes(),
            "line": made["line"].astype(np.int32).tobytes(), "page": page.astype(np.int32).tobytes(),
        }
        kinds = {"block": pa.int32(), "parts": pa.int32(), "host_pages": pa.int64(), "item": pa.list_(pa.string()), "doc": pa.list_(pa.int64()), "buckets": pa.list_(pa.binary())}
        return pa.table({k: pa.array([v], kinds.get(k, pa.string() if k == "host" else pa.binary())) for k, v in row.items()})

    made = placed.select("host", "block", *cols).repartition(partitions, "host", "block").groupBy("host", "block").applyInArrow(block, STREAM)
    return stage_table(made, "page_streams", bucketBy=(partitions, ["host", "block"]))


class Units:
    """What is counted of a stream: chosen parts, and the hashes of lines and of segments of several lines."""

    def __init__(self, row: dict):
        self.token, self.segment, self.line, self.page = (np.frombuffer(row[c], dtype=k) for c, k in (("token", np.uint64), ("segment", np.int32), ("line", np.int32), ("page", np.int32)))
        n = len(self.page)
        self.at_page = self.page[self.segment]
        self.is_mark = np.concatenate([self.segment[1:] != self.segment[:-1], [True]]) if n else np.zeros(0, dtype=bool)
        self.at, self.part = winnowed(self.token, self.at_page)
        word, seg = self.token[~self.is_mark], self.segment[~self.is_mark].astype(np.int64)
        self.lines, self.line_hash = _hashes(word, seg << 32 | self.line[~self.is_mark])
        self.line_segment = self.lines >> 32
        owner, whole = _hashes(word, seg)
        self.whole = np.zeros(n, dtype=np.uint64)
        self.whole[owner] = whole
        self.of_segment = np.bincount(self.line_segment, minlength=n)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(keys, pages of the stream on which each stands)."""
        several = self.of_segment > 1
        pages = [self.at_page[self.at], self.page[self.line_segment], self.page[several]]
        return page_counts(np.concatenate([self.part, self.line_hash, self.whole[several]]), np.concatenate(pages))


def _hashes(word: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(units, hash of the words of each); the words come unit by unit."""
    if not len(word):
        return unit, word
    start = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    place = (np.arange(len(word)) - np.repeat(start, np.diff(np.append(start, len(word))))).astype(np.uint64)
    return unit[start], words.mix(np.add.reduceat(words.mix(word + place * words.K2), start))


def _host_counts(streams: DataFrame) -> DataFrame:
    """(host, block, keys, pages): for the streams of hosts that have several, their keys that stand on more than one page of the whole host."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                key, n = Units(row).counts()
                m = len(key)
                yield pa.RecordBatch.from_arrays([pa.array([row["host"]] * m, pa.string()), pa.array(np.full(m, row["block"], dtype=np.int32)), pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["host", "block", "key", "n"])

    several = streams.filter("parts > 1").select("host", "block", "token", "segment", "line", "page")
    counts = several.mapInArrow(run, "host string, block int, key long, n long")
    repeated = counts.groupBy("host", "key").agg(F.sum("n").alias("n"), F.collect_list("block").alias("blocks")).filter("n > 1")
    own = repeated.select("host", F.explode("blocks").alias("block"), "key", "n").groupBy("host", "block")
    return own.agg(F.collect_list(F.struct("key", "n")).alias("of")).select("host", "block", F.col("of.key").alias("keys"), F.col("of.n").alias("pages"))


def repetition(row: dict) -> tuple[np.ndarray, list[list[int]]]:
    """(dense features of a stream's segments, their lines inside that are frame)."""
    u = Units(row)
    dense = np.frombuffer(row["dense"], dtype=np.float16).reshape(-1, N_DENSE).astype(np.float32)
    n, m = len(u.page), len(u.token)
    if row["parts"] > 1:
        key, count = np.array(row["keys"] or [], dtype=np.int64).view(np.uint64), np.array(row["pages"] or [], dtype=np.int64)
        order = np.argsort(key)
        key, count = key[order], count[order]
    else:
        key, count = u.counts()

    def pages_of(keys: np.ndarray) -> np.ndarray:
        if not len(key):
            return np.ones(len(keys), dtype=np.int64)
        i = np.minimum(np.searchsorted(key, keys), len(key) - 1)
        return np.where(key[i] == keys, count[i], 1)

    size = np.maximum(np.bincount(u.segment[~u.is_mark], minlength=n), 1)
    share = lambda c: np.bincount(u.segment[c & ~u.is_mark], minlength=n) / size
    on = pages_of(u.part)
    for column, least in ((0, 12), (1, 3), (2, 2), (3, 4)):
        dense[:, column] = share(long_runs(u.at, on >= least, u.at_page, m))
    longest = longest_elsewhere(u.token, u.at_page)
    for column, least in ((22, RUN), (23, RUN // 2)):
        start = np.flatnonzero(longest >= least)
        dense[:, column] = share(covered(start, longest[start], m))
    on_line = pages_of(u.line_hash)
    equal = pages_of(u.whole)
    one = u.of_segment[u.line_segment] == 1
    equal[u.line_segment[one]] = on_line[one]
    equal[u.of_segment == 0] = 1
    dense[:, 4] = np.log1p(equal - 1)
    dense[:, 5] = np.log1p(equal - 1) / np.log(row["host_pages"] + 1.0)
    dense[:, 6] = equal >= 3
    frame: list[list[int]] = [[] for _ in range(n)]
    for x in u.lines[~one & (on_line >= FRAME_PAGES)]:
        frame[x >> 32].append(int(x & 0xFFFFFFFF))
    return dense, frame


def segment_features(df: DataFrame) -> DataFrame:
    """``FEATURES`` of each distinct row of (item, doc, host, ord, kind, text, no_context), staged."""
    streams = _streams(df)
    counts = stage_table(_host_counts(streams), "host_counts")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                dense, frame = repetition(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["item"], pa.string()), pa.array(row["doc"], pa.int64()), pa.array([d.tobytes() for d in dense.astype(np.float16)], pa.binary()), pa.array(row["buckets"], pa.binary()), pa.array(frame, pa.list_(pa.int32()))],
                    names=[x.split()[0] for x in FEATURES.split(", ")],
                )

    with_counts = streams.join(counts, ["host", "block"], "left")
    found = stage_table(with_counts.mapInArrow(run, FEATURES), "page_features", replaces=streams)
    drop_table(counts)
    return found


class Model:
    """Logistic model over dense features, their pairs of coverage and form, and word buckets."""

    def __init__(self, dense: np.ndarray, buckets: list[bytes], label: np.ndarray, epochs: int = 250):
        x = self.expand(dense)
        rows, cols = self.sparse(buckets)
        y = label.astype(np.float64)
        w, v = np.zeros(x.shape[1]), np.zeros(BUCKETS)
        mw, sw, mv, sv = np.zeros_like(w), np.zeros_like(w), np.zeros_like(v), np.zeros_like(v)
        for t in range(1, epochs + 1):
            z = x @ w + np.bincount(rows, weights=v[cols], minlength=len(y))
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            gw = x.T @ g / len(y) + 1e-4 * w
            gv = np.bincount(cols, weights=g[rows], minlength=BUCKETS) / len(y) + 3e-5 * v
            for p, m, s, d in ((w, mw, sw, gw), (v, mv, sv, gv)):
                m += 0.1 * (d - m)
                s += 0.02 * (d * d - s)
                p -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.98**t)) + 1e-6)
        self.w, self.v = w.astype(np.float32), v.astype(np.float32)

    @staticmethod
    def expand(dense: np.ndarray) -> np.ndarray:
        cover, form = dense[:, :6], dense[:, [7, 8, 9, 10, 12, 15]]
        return np.concatenate([dense, (cover[:, :, None] * form[:, None, :]).reshape(len(dense), -1)], axis=1)

    @staticmethod
    def sparse(buckets: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(b) // 2 for b in buckets], dtype=np.int64)
        return np.repeat(np.arange(len(buckets)), size), np.frombuffer(b"".join(buckets), dtype=np.uint16).astype(np.int64)

    def probability(self, dense: np.ndarray, buckets: list[bytes]) -> np.ndarray:
        rows, cols = self.sparse(buckets)
        z = self.expand(dense) @ self.w + np.bincount(rows, weights=self.v[cols], minlength=len(dense))
        return np.where(dense[:, 19] > 0, 0.0, 1 / (1 + np.exp(-np.clip(z, -30, 30))))


class Coverage:
    """What decides without labels: a segment mostly covered by runs of other pages is frame."""

    def probability(self, dense: np.ndarray, buckets: list[bytes]) -> np.ndarray:
        frame = (dense[:, 2] > 0.7) | (dense[:, 6] > 0) | (dense[:, 19] > 0)
        return np.where(frame, 0.1, 0.9)


def _dense(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float16).reshape(-1, N_DENSE).astype(np.float32)


def main_scores(df: DataFrame, labels: DataFrame) -> DataFrame:
    """(item, doc, main, frame_lines): probability that a segment of (item, doc, host, ord, kind, text, no_context) is main body, and its lines that are frame even so.

    ``labels`` has (item, label); of an item labelled twice the greater counts.
    """
    found = segment_features(df)
    # bounded by MAX_LABELLED rows of two small columns
    wanted = labels.filter("item is not null and label is not null").groupBy("item").agg(F.max("label").alias("label")).orderBy(F.xxhash64("item")).limit(MAX_LABELLED)
    sample = found.join(F.broadcast(wanted), "item").select("item", "label", "dense", "buckets").orderBy("item").toArrow()
    label = sample.column("label").to_numpy()
    model = Coverage()
    if len(label) and 0 < label.mean() < 1:
        model = Model(_dense(sample.column("dense")), sample.column("buckets").to_pylist(), label)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                p = model.probability(_dense(batch.column(2)), batch.column(3).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p.astype(np.float64)), batch.column(4)], names=["item", "doc", "main", "frame_lines"])

    return found.select("item", "doc", "dense", "buckets", "frame_lines").mapInArrow(run, "item string, doc long, main double, frame_lines array<int>")
