"""Encoding of a corpus with a public byte-level BPE vocabulary by merge replay.

Each task splits its texts into words by the vocabulary's pattern, keeps every
distinct word of its texts once, and replays the merges over all of those words
together: an inverted index leads from the rank of a token pair to the
positions where the pair stands, ranks are taken in ascending order, and a merge
touches only the neighbours of the positions it joins. As a merged token's own
merges always have higher ranks, one ascending sweep is complete.

Null and empty texts give an empty list; strings that look like special tokens
are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of text whose distinct words share one replay; bounds a task's memory.
REPLAY_CHARS = 24_000_000


def default_vocabulary() -> str:
    """Path of byte_bpe_50k's rank file; every operator takes another as a parameter."""
    return "/opt/tokenizers/byte_bpe_50k.tiktoken"


#: Pattern that cuts text into words before the merges (fixed value of this vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Replay:
    """The merges of one rank file, ready to be applied to many words at once."""

    def __init__(self, path: str):
        import regex

        ranks = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    ranks[base64.b64decode(token)] = int(rank)
        self.split = regex.compile(PATTERN).findall
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.base = max(ranks.values()) + 1
        left, right, out = [], [], []
        for token, rank in ranks.items():
            if len(token) > 1:
                a, b = self._parts(token, rank, ranks)
                left.append(a)
                right.append(b)
                out.append(rank)
        keys = np.array(left, dtype=np.int64) * self.base + np.array(right, dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array(out, dtype=np.int32)[order]
        pair_of = np.zeros((self.base, 2), dtype=np.int32)
        pair_of[out, 0], pair_of[out, 1] = left, right
        self.pair_of = pair_of.tolist()

    @staticmethod
    def _parts(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[int, int]:
        """The two tokens whose merge gave ``token``: its encoding by lower ranks alone."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = rank, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1], rank)
                if r < best:
                    best, at = r, i
            if at < 0:
                raise ValueError(f"token {token!r} isn't made by lower ranks")
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return ranks[parts[0]], ranks[parts[1]]

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the vocabulary has no such merge."""
        key = a.astype(np.int64) * self.base + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, offsets of the words)."""
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        starts = np.zeros(len(coded) + 1, dtype=np.int64)
        np.cumsum(sizes, out=starts[1:])
        n = int(starts[-1])
        # a sentinel at the end, so that neighbours always exist
        sym = np.full(n + 1, -1, dtype=np.int32)
        sym[:n] = self.byte_id[np.frombuffer(b"".join(coded), dtype=np.uint8)]
        nxt = np.arange(1, n + 2, dtype=np.int32)
        prv = np.arange(-1, n, dtype=np.int32)
        firsts = starts[:-1][sizes > 0]
        lasts = starts[1:][sizes > 0] - 1
        nxt[lasts] = n
        prv[firsts] = n
        nxt[n] = prv[n] = n
        at = np.flatnonzero(nxt[:n] != n)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def put(pos: np.ndarray, rank: np.ndarray) -> None:
            if len(rank) == 1:
                r = int(rank[0])
                if r < 0:
                    return
                if r in index:
                    index[r].append(pos)
                else:
                    index[r] = [pos]
                    heapq.heappush(heap, r)
                return
            order = np.argsort(rank, kind="stable")
            rank, pos = rank[order], pos[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            bounds = [0, *cut.tolist(), len(rank)]
            for i, j in zip(bounds[:-1], bounds[1:]):
                r = int(rank[i])
                if r < 0:
                    continue
                if r in index:
                    index[r].append(pos[i:j])
                else:
                    index[r] = [pos[i:j]]
                    heapq.heappush(heap, r)

        if len(at):
            put(at.astype(np.int32), self.rank_of(sym[at], sym[nxt[at]]))
        while heap:
            r = heapq.heappop(heap)
            a, b = self.pair_of[r]
            lists = index.pop(r)
            p = lists[0] if len(lists) == 1 else np.concatenate(lists)
            q = nxt[p]
            ok = (sym[p] == a) & (sym[q] == b)
            p, q = p[ok], q[ok]
            if not len(p):
                continue
            if a == b and len(p) > 1:
                p, q = self._apart(np.unique(p), nxt)
            after = nxt[q]
            before = prv[p]
            sym[p] = r
            sym[q] = -1
            nxt[p] = after
            prv[after] = p
            prv[n] = n
            left = before[before != n]
            right = p[after != n]
            if len(left) or len(right):
                pos = np.concatenate([left, right])
                put(pos, self.rank_of(sym[pos], sym[nxt[pos]]))
        alive = sym[:n] >= 0
        ends = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(alive, out=ends[1:])
        return sym[:n][alive], ends[starts]

    @staticmethod
    def _apart(p: np.ndarray, nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of overlapping pairs of one token, each run's every second from the left."""
        q = nxt[p]
        joined = np.zeros(len(p), dtype=bool)
        joined[1:] = q[:-1] == p[1:]
        run = np.maximum.accumulate(np.where(joined, 0, np.arange(len(p))))
        keep = (np.arange(len(p)) - run) % 2 == 0
        return p[keep], q[keep]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of the texts).

        A blank after a character that isn't white space always begins a word,
        so texts are first cut there, and only distinct cuts are split further.
        """
        seen: dict[tuple[bool, str] | str, int] = {}
        after_blank, at_start = _Number(seen, " "), _Number(seen, "")
        number, first = after_blank.__getitem__, at_start.__getitem__
        rows, counts = [], np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            if not t:
                continue
            cuts = t.split(" ") if _BLANK_AFTER_SPACE(t) is None else _CUT_AT_BLANK(t)
            counts[i] = len(cuts)
            row = np.empty(len(cuts), dtype=np.int32)
            row[0] = first(cuts[0])
            row[1:] = np.fromiter(map(number, cuts[1:]), dtype=np.int32, count=len(cuts) - 1)
            rows.append(row)
        if not rows:
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        distinct: dict[str, int] = {}
        words, in_cut = [], np.zeros(len(seen) + 1, dtype=np.int64)
        for k, cut in enumerate(seen):
            for w in self.split(cut[1] if isinstance(cut, tuple) else cut):
                words.append(distinct.setdefault(w, len(distinct)))
            in_cut[k + 1] = len(words)
        ids, word_offs = _laid_out(np.array(words, dtype=np.int64), *self.encode_words(list(distinct)))
        offs = word_offs[in_cut]
        cut = np.concatenate(rows)
        out, ends = _laid_out(cut, ids, offs)
        bounds = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(counts, out=bounds[1:])
        return out, ends[bounds]


def _laid_out(item: np.ndarray, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a row of items, each item's ids standing in ``ids`` between its offsets; and where each begins."""
    size = np.diff(offs)[item]
    ends = np.zeros(len(item) + 1, dtype=np.int64)
    np.cumsum(size, out=ends[1:])
    # where an id comes from: the start of its item, plus its place in it
    source = np.repeat(offs[item] - ends[:-1], size)
    source += np.arange(len(source))
    return ids[source], ends


#: White space before a blank: the blank may then belong to a run that is a word of its own.
_BLANK_AFTER_SPACE = re.compile(r"\s ").search
_CUT_AT_BLANK = re.compile(r"(?<=\S) ").split


class _Number(dict):
    """Numbers cuts in the order they are first seen, with or without a leading blank."""

    def __init__(self, seen: dict, lead: str):
        self.seen, self.lead = seen, lead

    def __missing__(self, cut: str) -> int:
        k = self[cut] = len(self.seen)
        self.seen[self.lead + cut if self.lead else (True, cut)] = k
        return k


@lru_cache(maxsize=2)
def replay(path: str) -> Replay:
    """One per Python worker and rank file."""
    return Replay(path)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, chars = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            held.append(part)
            chars += part.column(1).nbytes
            if chars >= REPLAY_CHARS:
                yield held
                held, chars = [], 0
    if held:
        yield held


def encode_corpus(df: DataFrame, key: str, text: str, vocabulary: str | None = None, out: str = "ids") -> DataFrame:
    """(key, ids) of every row; ``ids`` is an array of int, empty for null and empty texts."""
    path = vocabulary or default_vocabulary()

    def run(batches):
        coder = replay(path)
        for held in _groups(batches):
            texts = [t for b in held for t in b.column(1).to_pylist()]
            ids, ends = coder.encode(texts)
            keys = pa.concat_arrays([b.column(0) for b in held])
            for i in range(0, len(texts), 2048):
                e = ends[i : min(i + 2048, len(texts)) + 1]
                lists = pa.ListArray.from_arrays(pa.array((e - e[0]).astype(np.int32)), pa.array(ids[e[0] : e[-1]]))
                yield pa.RecordBatch.from_arrays([keys.slice(i, len(e) - 1), lists], names=[key, out])

    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField(out, T.ArrayType(T.IntegerType()))])
    return df.select(F.col(key), F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def token_counts(df: DataFrame, key: str, text: str, vocabulary: str | None = None, out: str = "n_tokens") -> DataFrame:
    """(key, number of tokens) of every row, without shipping the ids back."""
    path = vocabulary or default_vocabulary()

    def run(batches):
        coder = replay(path)
        for held in _groups(batches):
            texts = [t for b in held for t in b.column(1).to_pylist()]
            _, ends = coder.encode(texts)
            keys = pa.concat_arrays([b.column(0) for b in held])
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(ends))], names=[key, out])

    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField(out, T.LongType())])
    return df.select(F.col(key), F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)
