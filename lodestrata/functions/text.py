"""Scalar functions on texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower case of the ASCII letters alone, as LIKE of the store folds."""
    return F.translate(c, _UPPER, _LOWER)


def like_any(c: Column, parts: list[str]) -> Column:
    """Whether a text holds any of the parts, ASCII letters compared without case."""
    low = ascii_lower(c)
    out = F.lit(False)
    for p in parts:
        out = out | low.contains(p)
    return out


def hits(c: Column, words: list[str]) -> Column:
    """Number of matches of a word list that don't overlap."""
    return F.regexp_count(c, F.lit(lexicon.java(words)))


def is_negative(c: Column) -> Column:
    return c.rlike(lexicon.java(lexicon.NEGATIVE)).cast("int")


def segment_features(c: Column) -> Column:
    """(impact_score, hit_count, is_negative): 25 for each hit, 80 less for a negative text, and one for each 250 characters up to eight."""
    found, negative = hits(c, lexicon.POSITIVE), is_negative(c)
    return F.struct(
        (25 * found - 80 * negative + F.least(F.floor(F.char_length(c) / 250), F.lit(8)).cast("int")).alias("impact_score"), found.alias("hit_count"), negative.alias("is_negative")
    )


def segment_score(c: Column) -> Column:
    return segment_features(c)["impact_score"]


def clean_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def page_clean(c: Column) -> Column:
    """Runs of three or more blanks and tabs as one blank."""
    return F.regexp_replace(c, r"[ \t]{3,}", " ")


def entity_norm(c: Column) -> Column:
    """Lower-cased name without a legal suffix at its end, marks, articles and prepositions."""
    x = F.regexp_replace(F.trim(c), rf"(?iu)\s*\b(?:{lexicon.LEGAL_SUFFIXES})\s*$", "")
    x = F.regexp_replace(x, r"[^\p{L}\p{N}_\- ]+", " ")
    x = F.regexp_replace(x, rf"(?iuU)\b(?:{'|'.join(lexicon.ARTICLES)})\b", " ")
    return F.lower(clean_ws(x))


def entity_key(name: Column, kind: Column, category: Column) -> Column:
    """Stable key of an entity: type, category and the name without marks."""
    n = F.regexp_replace(F.lower(clean_ws(name)), r"[^\p{L}\p{N}_\- ]+", "")
    return F.concat_ws("::", kind, category, clean_ws(n))


def safe_relation(c: Column) -> Column:
    name = F.replace(F.upper(F.trim(c)), F.lit(" "), F.lit("_"))
    return F.when(name.isin(lexicon.RELATIONS), name).otherwise(F.lit(lexicon.ANY_RELATION))


def norm_name(c: Column) -> Column:
    """White space collapsed, long dashes as hyphens."""
    return F.translate(clean_ws(c), "–—", "--")


def ags_norm(c: Column) -> Column:
    """Eight digits, a leading zero added to seven; empty for anything else."""
    d = F.regexp_replace(F.coalesce(c, F.lit("")), r"\D", "")
    d = F.when(F.length(d) == 7, F.lpad(d, 8, "0")).otherwise(d)
    return F.when(F.length(d) == 8, d).otherwise(F.lit(""))


def token_windows(words: Column, size: int, overlap: int) -> Column:
    """Windows (start, end, tokens) of ``size`` tokens of an array, each sharing ``overlap`` with the one before."""
    stride = size - overlap
    if stride <= 0:
        raise ValueError("overlap must be smaller than size")
    n = F.size(words)
    k = F.when(n <= size, 1).otherwise(F.ceil((n - overlap) / stride)).cast("int")
    return F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(0), k - 1),
            lambda i: F.struct((i * stride).alias("start"), F.least(i * stride + size, n).alias("end"), F.slice(words, i * stride + 1, size).alias("tokens")),
        ),
    )


def page_pieces(page: Column, most: int = 3000, least: int = 200) -> Column:
    """Pieces of a page: whole if short, else its paragraphs merged up to ``most`` characters, those under ``least`` dropped, or the whole page if none is left."""
    paragraphs = F.filter(F.transform(F.split(page, r"\n{2,}"), lambda p: F.trim(p)), lambda p: p != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def step(acc, p):
        joined = F.when(acc["cur"] == "", p).otherwise(F.concat(acc["cur"], F.lit("\n\n"), p))
        fits = F.char_length(joined) <= most
        return F.struct(
            F.when(fits, acc["done"]).otherwise(F.array_append(acc["done"], acc["cur"])).alias("done"),
            F.when(fits, joined).otherwise(p).alias("cur"),
        )

    pieces = F.aggregate(paragraphs, start, step, lambda acc: F.filter(F.array_append(acc["done"], acc["cur"]), lambda x: F.char_length(x) >= least))
    return F.when(F.char_length(page) <= most, F.array(page)).when(F.size(pieces) > 0, pieces).otherwise(F.array(page))


def without_fences(c: Column) -> Column:
    """A reply without its code fences."""
    return F.trim(F.regexp_replace(c, r"```(?:json)?", ""))
