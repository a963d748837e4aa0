"""Reading level of documents by the median of classic readability grades.

The main text of a document is its prose: in texts whose lines are wrapped the
lines are put together first, otherwise lines without an end of sentence
(menus, titles, imprints) are left out; a text of nothing but such lines counts
each as a sentence. Sentence, word, letter and syllable
counts are taken over arrays of character classes, many texts at a time.
Syllables follow hyphenation-like rules: a run of vowels is one nucleus, hiatus
pairs are two, and an English final silent e is none.

Six formulas give one estimate each. Estimates have different scales, so each
is brought to the scale of the raters' levels by three cuts, fitted on a bounded
sample of labelled documents by least absolute error; the median of the six is
the level. Languages have their own cuts and are told apart by function words,
not by the unreliable ``lang``.

Null, empty and wordless texts have a null level.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled documents used at most for fitting the cuts, those with the smallest hash.
MAX_LABELLED = 20_000
#: Characters whose counts are taken together; bounds a task's memory.
BLOCK_CHARS = 3_000_000
#: Share of a text's lines beginning with a small letter from which the text counts as wrapped.
WRAPPED_SHARE = 0.15

FORMULAS = ("lix", "wiener", "amstad", "kincaid", "ari", "coleman")
COUNTS = ("sentences", "words", "letters", "long", "nuclei", "silent", "poly", "mono", "de", "en")

#: Function words by which the two languages are told apart.
GERMAN = (" der ", " die ", " das ", " und ", " ist ", " den ", " mit ", " dem ")
ENGLISH = (" the ", " and ", " of ", " is ", " to ", " with ", " by ", " a ")

_LETTER, _LOWER, _VOWEL, _DIGIT, _SPACE, _END, _HYPHEN = 1, 2, 4, 8, 16, 32, 64


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Flags of each code point of the basic plane; the last entry serves all beyond."""
    import unicodedata

    flags = np.zeros(0x10001, dtype=np.uint8)
    for cp in range(0x10000):
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind[0] == "L":
            flags[cp] = _LETTER | (_LOWER if kind == "Ll" else 0)
            base = unicodedata.normalize("NFD", c)[0].lower()
            if base in "aeiouyæøœ":
                flags[cp] |= _VOWEL
        elif kind[0] == "N":
            flags[cp] = _DIGIT
        elif c.isspace():
            flags[cp] = _SPACE
        elif c in ".!?;…":
            flags[cp] = _END
        elif c in "-\u00ad\u2010":
            flags[cp] = _HYPHEN
    return flags


def count_texts(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` of each text's main text."""
    out = {k: np.zeros(len(texts), dtype=np.int64) for k in COUNTS}
    start = 0
    while start < len(texts):
        stop, chars = start, 0
        while stop < len(texts) and (stop == start or chars + len(texts[stop] or "") <= BLOCK_CHARS):
            chars += len(texts[stop] or "")
            stop += 1
        _count_block(texts[start:stop], {k: v[start:stop] for k, v in out.items()})
        start = stop
    for i, t in enumerate(texts):
        if t:
            low = t.lower()
            out["de"][i] = sum(map(low.count, GERMAN))
            out["en"][i] = sum(map(low.count, ENGLISH))
    return out


def _count_block(texts: list[str | None], out: dict[str, np.ndarray]) -> None:
    # every text ends with a line break of its own, so no word or line reaches into the next
    code = np.frombuffer("".join([(t or "") + "\n" for t in texts]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter((len(t or "") + 1 for t in texts), dtype=np.int64, count=len(texts))
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    c = _classes()[np.minimum(code, 0x10000)]
    brk = code == 10
    ends = np.flatnonzero(brk)
    starts = np.concatenate([[0], ends[:-1] + 1])
    line_doc = doc[ends]
    # first and last character of each line that isn't white space
    solid = np.flatnonzero((c & _SPACE) == 0)
    blank = np.ones(len(ends), dtype=bool)
    begins_low = np.zeros(len(ends), dtype=bool)
    ends_well = np.zeros(len(ends), dtype=bool)
    if len(solid):
        i = np.minimum(np.searchsorted(solid, starts), len(solid) - 1)
        j = np.maximum(np.searchsorted(solid, ends) - 1, 0)
        blank = (solid[i] < starts) | (solid[i] >= ends)
        begins_low = ~blank & ((c[solid[i]] & _LOWER) > 0)
        last = c[solid[j]]
        before = c[solid[np.maximum(j - 1, 0)]]
        ends_well = ~blank & (((last & _END) > 0) | (((last & (_LETTER | _DIGIT)) == 0) & ((before & _END) > 0)))
    n_lines = np.bincount(line_doc[~blank], minlength=len(texts))
    n_low = np.bincount(line_doc[begins_low], minlength=len(texts))
    wrapped = n_low >= np.maximum(WRAPPED_SHARE * n_lines, 3)
    stops = _sentence_ends(c)
    per_line = np.add.reduceat(stops.astype(np.int32), starts)
    length = ends - starts
    good = (ends_well & (length >= 20)) | ((per_line >= 2) & (length >= 150))
    keep_line = np.where(wrapped[line_doc], ~blank, good)
    none = np.bincount(line_doc[keep_line], minlength=len(texts)) == 0
    keep_line |= none[line_doc] & ~blank
    keep = np.repeat(keep_line, length + 1)
    # a hyphen at the end of a wrapped line and the break go, where a small letter follows
    hyphen = np.flatnonzero(brk[1:] & ((c[:-1] & _HYPHEN) > 0) & wrapped[doc[:-1]])
    hyphen = hyphen[hyphen + 2 < len(c)]
    hyphen = hyphen[(c[hyphen + 2] & _LOWER) > 0]
    keep[hyphen] = False
    keep[hyphen + 1] = False
    c, doc = c[keep], doc[keep]
    code = code[keep]
    if not len(c):
        return
    n = len(texts)
    letter = (c & _LETTER) > 0
    vowel = (c & _VOWEL) > 0
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    at = np.flatnonzero(first)
    if not len(at):
        return
    after = np.flatnonzero(letter & ~np.concatenate([letter[1:], [False]])) + 1
    word_doc = doc[at]
    size = after - at
    nucleus = vowel.copy()
    nucleus[1:] &= ~vowel[:-1]
    low = code | np.where(code < 128, 32, 0).astype(np.uint32)
    # two nuclei in a row: i or u before another vowel that doesn't make a diphthong with it
    hiatus = np.zeros(len(c), dtype=bool)
    hiatus[1:] = (low[:-1] == ord("i")) & ((low[1:] == ord("a")) | (low[1:] == ord("o")) | (low[1:] == ord("u")))
    nuclei = np.add.reduceat((nucleus | hiatus).astype(np.int32), at)
    nuclei = np.maximum(nuclei, 1)
    final = after - 1
    silent = (size > 2) & (low[final] == ord("e")) & ~vowel[np.maximum(final - 1, 0)]
    put = lambda k, docs: out[k].__iadd__(np.bincount(docs, minlength=n))
    put("sentences", doc[_sentence_ends(c)])
    put("sentences", line_doc[none[line_doc] & ~blank])
    put("words", word_doc)
    put("letters", doc[letter])
    put("long", word_doc[size > 6])
    out["nuclei"] += np.bincount(word_doc, weights=nuclei, minlength=n).astype(np.int64)
    put("silent", word_doc[silent])
    put("poly", word_doc[nuclei >= 3])
    put("mono", word_doc[nuclei == 1])


def _sentence_ends(c: np.ndarray) -> np.ndarray:
    """Where a sentence ends: a mark after two letters, before white space or a closing mark."""
    end = (c & _END) > 0
    letter = (c & _LETTER) > 0
    two = np.zeros(len(c), dtype=bool)
    two[2:] = letter[1:-1] & letter[:-2]
    plain = (c & (_LETTER | _DIGIT | _END)) == 0
    then = np.concatenate([plain[1:], [True]])
    return end & two & then


def counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, counts) of every row."""

    def run(batches):
        for batch in batches:
            found = count_texts(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[k]) for k in COUNTS)], names=[key, *COUNTS])

    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *(T.StructField(k, T.LongType()) for k in COUNTS)])
    return df.select(F.col(key), F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def estimates(df: DataFrame) -> DataFrame:
    """Adds ``language`` and one column per formula; null where there are no words."""
    n = lambda k: F.col(k).cast("double")
    words = F.when(n("words") > 0, n("words"))
    english = n("en") > n("de")
    sl = n("words") / F.greatest(n("sentences"), F.lit(1.0))
    syl = (n("nuclei") - F.when(english, n("silent")).otherwise(0.0)) / words
    long_pct, poly_pct, mono_pct = (100 * n(k) / words for k in ("long", "poly", "mono"))
    per_word = n("letters") / words
    return df.withColumns(
        {
            "language": F.when(english, F.lit("en")).otherwise(F.lit("de")),
            "lix": F.when(words > 0, sl + long_pct),
            "wiener": 0.1935 * poly_pct + 0.1672 * sl + 0.1297 * long_pct - 0.0327 * mono_pct - 0.875,
            "amstad": -(180 - sl - 58.5 * syl),
            "kincaid": 0.39 * sl + 11.8 * syl - 15.59,
            "ari": 4.71 * per_word + 0.5 * sl - 21.43,
            "coleman": 5.88 * per_word - 29.6 / sl - 15.8,
        }
    ).drop(*COUNTS)


@dataclass
class Cuts:
    """Where each formula passes from one level to the next, by language."""

    of: dict[str, dict[str, tuple[float, float, float]]] = field(default_factory=dict)


def fit(labelled: DataFrame) -> Cuts:
    """Cuts of each formula from a bounded sample with columns of ``estimates`` and ``level``.

    A language with too few labels uses the cuts of all labels together.
    """
    rows = (
        labelled.filter(F.col("level").between(1, 4) & F.col("lix").isNotNull())
        .orderBy(F.xxhash64("doc_id"), "level")
        .limit(MAX_LABELLED)
        .select("language", "level", *FORMULAS)
        .toPandas()
    )
    cuts = Cuts()
    for language in ("de", "en"):
        own = rows[rows.language == language]
        if len(own) < 40 or own.level.nunique() < 4:
            own = rows
        if len(own) == 0:
            continue
        cuts.of[language] = {f: tuple(_cut(own[f].to_numpy(), own.level.to_numpy(), k) for k in (1, 2, 3)) for f in FORMULAS}
        for f in FORMULAS:  # cuts ascend
            cuts.of[language][f] = tuple(np.maximum.accumulate(cuts.of[language][f]).tolist())
    return cuts


def _cut(x: np.ndarray, level: np.ndarray, k: int) -> float:
    """Value that best divides the levels up to k from those above; the middle of the best range."""
    order = np.argsort(x, kind="stable")
    x, above = x[order], (level[order] > k).astype(int)
    # errors of a cut before position i: those above that lie below it, and the rest at or after it
    errors = np.concatenate([[0], np.cumsum(above)]) + (len(x) - above.sum()) - np.concatenate([[0], np.cumsum(1 - above)])
    best = np.flatnonzero(errors == errors.min())
    i = int(best[len(best) // 2])
    if i == 0:
        return float(x[0]) - 1e-9
    if i == len(x):
        return float(x[-1]) + 1e-9
    return float(x[i - 1] + x[i]) / 2


def levels(df: DataFrame, cuts: Cuts) -> DataFrame:
    """Adds ``level``: the median over formulas of the place among the cuts, rounded."""

    def place(f: str, language: str) -> Column:
        a, b, c = cuts.of[language][f]
        x = F.col(f)
        inner = lambda lo, hi, base: base + (x - lo) / max(hi - lo, 1e-6)
        return (
            F.when(x < a, F.greatest(F.lit(1.0), 1.5 + (x - a) / max(b - a, 1e-6)))
            .when(x < b, inner(a, b, 1.5))
            .when(x < c, inner(b, c, 2.5))
            .otherwise(F.least(F.lit(4.0), 3.5 + (x - c) / max(c - b, 1e-6)))
        )

    if not cuts.of:
        return df.withColumn("level", F.lit(None).cast("int"))
    languages = sorted(cuts.of)
    medians = []
    for language in languages:
        s = F.array_sort(F.array(*[place(f, language) for f in FORMULAS]))
        mid = len(FORMULAS) // 2
        medians.append((language, (F.element_at(s, mid) + F.element_at(s, mid + 1)) / 2))
    m = F.lit(None).cast("double")
    for language, value in medians:
        m = F.when(F.col("language") == language, value).otherwise(m)
    level = F.least(F.greatest(F.floor(m + 0.5), F.lit(1)), F.lit(4)).cast("int")
    return df.withColumn("level", F.when(F.col("lix").isNotNull(), level))


def reading_levels(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, language, the six estimates, level) of every document, cuts fitted on ``labels``."""
    graded = estimates(counts(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text")), "doc_id", "_text"))
    wanted = labels.filter(F.col("level").isNotNull()).select(F.col(key).alias("doc_id"), F.col("level").cast("int").alias("level"))
    sample = wanted.orderBy(F.xxhash64("doc_id"), "level").limit(MAX_LABELLED)
    few = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text")).join(F.broadcast(sample.select("doc_id").distinct()), "doc_id")
    cuts = fit(estimates(counts(few, "doc_id", "_text")).join(F.broadcast(sample), "doc_id"))
    return levels(graded, cuts).withColumnRenamed("doc_id", key)
