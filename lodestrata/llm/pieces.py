"""Content-defined splitting of oversized texts at natural boundaries.

A rolling hash over ``WINDOW`` characters marks landmarks; each landmark snaps
to the nearest end of a line or sentence within ``SNAP`` characters, else to the
nearest word's end, else stays. A cut is the first snapped landmark beyond the
minimum size; without one, the last natural boundary before the limit, and
without any boundary the limit itself. As landmarks depend on nothing but the
characters around them, an edit changes only the pieces near it.

A piece begins ``overlap`` words before the cut that ends the one before it. The
limit holds first: the overlap shrinks where it would fill more than half of a
piece, and never reaches back to the beginning of the piece before.

Blanks (U+0020) at both ends are cut off first. Null texts and texts within the
limit give no pieces; a null overlap means ``default_overlap``, a negative none.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words

WINDOW, SNAP, EVERY = 24, 160, 512

_LINE = re.compile(r"\n\s*")
_SENTENCE = re.compile(r"(?<=[^\W\d]{2}[.!?;:…])[\"»“”)\]]?\s+|(?<=[。！？])")
_WORD = re.compile(r"\s+")


def _ends(pattern: re.Pattern, text: str) -> np.ndarray:
    return np.fromiter((m.end() for m in pattern.finditer(text)), dtype=np.int64)


def _nearest(sorted_to: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Nearest of ``sorted_to`` to each position; far away where there is none."""
    if not len(sorted_to):
        return np.full(len(at), -(1 << 40), dtype=np.int64)
    right = np.minimum(np.searchsorted(sorted_to, at), len(sorted_to) - 1)
    left = np.maximum(right - 1, 0)
    lower, upper = sorted_to[left], sorted_to[right]
    return np.where(np.abs(at - lower) <= np.abs(upper - at), lower, upper)


def landmarks(text: str, natural: np.ndarray, spaces: np.ndarray) -> np.ndarray:
    """Snapped landmarks of a text, ascending."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if len(code) <= WINDOW:
        return np.zeros(0, dtype=np.int64)
    value = words.mix(code.astype(np.uint64) + np.uint64(1))
    h = np.zeros(len(code) - WINDOW + 1, dtype=np.uint64)
    for j in range(WINDOW):
        h = h * words.K1 + value[j : j + len(h)]
    at = np.flatnonzero(words.mix(h) % np.uint64(EVERY) == 0) + WINDOW
    snapped = _nearest(natural, at)
    word = _nearest(spaces, at)
    snapped = np.where(np.abs(snapped - at) <= SNAP, snapped, np.where(np.abs(word - at) <= SNAP, word, at))
    return np.unique(snapped)


def split(text: str, overlap: int, limit: int = 2000, least: int = 600) -> list[tuple[int, int, int]]:
    """(start, cut before, end) of each piece: a piece shares start..cut with the one before it."""
    n = len(text)
    if n <= limit:
        return [(0, 0, n)]
    spaces = _ends(_WORD, text)
    natural = np.unique(np.concatenate([_ends(_LINE, text), _ends(_SENTENCE, text)]))
    marks = landmarks(text, natural, spaces)
    word_starts = np.unique(np.concatenate([[0], spaces]))
    out, start, cut = [], 0, 0
    while True:
        most = start + limit
        if most >= n:
            out.append((start, cut, n))
            return out
        low = min(cut + least, most)
        i = np.searchsorted(marks, low)
        if i < len(marks) and marks[i] <= most:
            end = int(marks[i])
        else:
            end = most
            for kind in (natural, spaces):
                j = np.searchsorted(kind, most, side="right") - 1
                if j >= 0 and kind[j] >= low:
                    end = int(kind[j])
                    break
        out.append((start, cut, end))
        k = np.searchsorted(word_starts, end)  # words that begin before the cut
        back = int(word_starts[max(k - overlap, 0)]) if overlap > 0 and k > 0 else end
        floor = max(start + 1, end - limit // 2)
        if back < floor:  # the nearest whole word within the room
            j = np.searchsorted(word_starts, floor)
            back = int(word_starts[j]) if j < len(word_starts) and word_starts[j] < end else end
        start, cut = back, end


PIECES = "item string, piece_no int, start int, shared int, stop int, piece string"


def oversized(df: DataFrame, item: str, text: str, limit: int = 2000) -> DataFrame:
    """Rows of ``df`` whose text is longer than the limit after blanks at both ends are cut off."""
    return df.filter(F.col(item).isNotNull() & (F.char_length(F.trim(text)) > limit))


def split_texts(df: DataFrame, item: str, text: str, overlap: str, limit: int = 2000, least: int = 600, default_overlap: int = 20) -> DataFrame:
    """(item, piece_no, start, shared, stop, piece) of every oversized text; ``shared`` characters belong to the piece before."""

    def run(batches):
        for batch in batches:
            rows = {k: [] for k in ("item", "piece_no", "start", "shared", "stop", "piece")}
            for key, t, words_shared in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for no, (start, cut, stop) in enumerate(split(t, words_shared, limit, least)):
                    for k, v in zip(rows, (key, no, start, cut - start, stop, t[start:stop])):
                        rows[k].append(v)
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=list(rows))

    wanted = oversized(df, item, text, limit).select(F.col(item).cast("string").alias("item"), F.trim(text).alias("t"), F.coalesce(F.col(overlap), F.lit(default_overlap)).cast("int").alias("o"))
    return wanted.mapInArrow(run, PIECES)
