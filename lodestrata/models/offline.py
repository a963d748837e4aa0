"""Deterministic defaults where a deployment plugs in a model: embedding, extraction, summary, report, routing and judging.

Each takes the place of a call with a fixed schema; a provider is any function
of the same shape. All are column expressions or Arrow functions, so a provider
that needs a service is called once a batch.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx


def _hashing(texts: list[str], dim: int) -> np.ndarray:
    """Hashed words, signed and normalised; empty texts give the first unit vector."""
    import zlib

    out = np.zeros((len(texts), dim), dtype=np.float32)
    for i, t in enumerate(texts):
        for w in t.lower().split():
            h = zlib.crc32(w.encode("utf-8", "surrogatepass"))
            out[i, h % dim] += 1.0 if h >> 16 & 1 else -1.0
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    out[norm[:, 0] == 0, 0] = 1.0
    norm[norm == 0] = 1.0
    return out / norm


def embed(df: DataFrame, key: str, text: str, dim: int = 384, provider: Callable[[list[str], int], np.ndarray] = _hashing) -> DataFrame:
    """(key, embedding): unit vectors of the texts, a batch at a time."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            v = np.asarray(provider([t or "" for t in batch.column(1).to_pylist()], dim), dtype=np.float32)
            offsets = pa.array(np.arange(0, len(v) * dim + 1, dim, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(v.ravel()))], names=[key, "embedding"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, embedding array<float>")


#: Words that begin an entity of each type, for the offline extractor.
GAZETTEER = {"Infrastruktur": "Wärmenetz|Windpark|Solarpark|Umspannwerk|Heizung", "Konzept/Ziel": r"\p{Lu}\p{L}*(?:konzept|plan|strategie|ziel)", "Maßnahme": r"\p{Lu}\p{L}*(?:maßnahme|programm|projekt)"}


def extract(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, name, type): entities by word forms, each name of a text once."""
    each = [F.transform(F.regexp_extract_all(text, F.lit(rf"\b(?:{p})\b"), F.lit(0)), lambda x, k=k: F.struct(x.alias("name"), F.lit(k).alias("type"))) for k, p in GAZETTEER.items()]
    return df.select(key, F.explode(F.array_distinct(F.concat(*each))).alias("e")).select(key, "e.name", "e.type")


def relations(entities: DataFrame, key: str) -> DataFrame:
    """(key, source, target): each entity of a text with the one before it."""
    w = Window.partitionBy(key).orderBy("name", "type")
    return entities.select(key, F.lag("name").over(w).alias("source"), F.col("name").alias("target")).filter("source is not null")


def merge_rounds(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Entities of two rounds of extraction, the first of each name without case."""
    both = first.withColumn("round", F.lit(0)).unionByName(second.withColumn("round", F.lit(1)))
    best = both.groupBy(key, F.lower("name").alias("low")).agg(F.min(F.struct("round", "name", "type")).alias("b"))
    return best.select(key, "b.name", "b.type")


def summaries(segments: DataFrame, doc: str, n: int = 3) -> DataFrame:
    """(doc, summary, years, n_segments): the best passages of a document and the years it names."""
    w = Window.partitionBy(doc).orderBy(F.desc(F.coalesce("impact_score", F.lit(0))), "segment_id")
    top = segments.withColumn("r", F.row_number().over(w)).withColumn("y", F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\b(?:19|20)\d\d\b"), F.lit(0)))
    return top.groupBy(doc).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("r") <= n, F.struct("r", F.substring("text", 1, 200).alias("t"))))), lambda x: x["t"]), " ").alias("summary"),
        F.concat_ws("-", F.min(F.array_min("y")), F.max(F.array_max("y"))).alias("years"),
        F.count("*").alias("n_segments"),
    )


def reports(members: DataFrame) -> DataFrame:
    """(community, title, importance) from a template, for members (node, community)."""
    per = members.groupBy("community").agg(F.count("*").alias("n"), F.min("node").alias("first"))
    return per.select("community", F.concat(F.lit("Gruppe um "), F.col("first").cast("string"), F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("title"), F.least(F.ceil(F.log2(F.col("n") + 1.0)), F.lit(10)).cast("int").alias("importance"))


def route(question: Column) -> Column:
    """Which search answers a question: counts and lists go to the structured one, overviews to the global one."""
    low = F.lower(question)
    return F.when(low.rlike("wie viele|anzahl|liste|how many|count"), "structured").when(low.rlike("überblick|insgesamt|trend|themen|overview|summar"), "global").otherwise("local")


def _words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: F.char_length(w) > 3))


def overlap(a: Column, b: Column) -> Column:
    """Share of the longer words of ``a`` that ``b`` holds; null where ``a`` has none."""
    w = _words(a)
    return F.when(F.size(w) > 0, F.size(F.array_intersect(w, _words(b))) / F.size(w))


def claims(answer: Column, most: int = 10) -> Column:
    """Sentences of an answer that state something: at least three longer words, the first ``most``."""
    parts = F.transform(F.split(F.coalesce(answer, F.lit("")), r"(?<=[.!?])\s+"), lambda x: F.trim(x))
    return F.slice(F.filter(parts, lambda x: F.size(_words(x)) >= 3), 1, most)


def claim_support(answer: Column, context: Column, least: float = 0.6) -> Column:
    """(claims, supported): how many claims of an answer there are and how many share enough words with the context; the same claims count for both."""
    found = claims(answer)
    return F.struct(F.size(found).alias("claims"), F.size(F.filter(found, lambda x: F.coalesce(overlap(x, context), F.lit(0.0)) >= least)).alias("supported"))


def compare(question: Column, a: Column, b: Column) -> Column:
    """Winner of two answers: the one that shares more words with the question, then the one with more different words, else a tie."""
    of = lambda x: F.struct(F.coalesce(overlap(question, x), F.lit(0.0)).alias("o"), F.size(_words(x)).alias("w"))
    return F.when(of(a) > of(b), "A").when(of(b) > of(a), "B").otherwise("tie")


def judge(question: Column, answer: Column, context: Column) -> Column:
    """(faithfulness, recall) by shared words."""
    return F.struct(F.round(overlap(answer, context), 4).alias("faithfulness"), F.round(overlap(question, context), 4).alias("recall"))


#: Types of entities that a reply may have; others are left out.
ENTITY_TYPES = ["Akteur", "Dokument", "Infrastruktur", "Konzept/Ziel", "Maßnahme", "Ort"]


def counted(asked: DataFrame, question: str, facts: DataFrame) -> DataFrame:
    """Adds ``n`` to questions of the form "how many documents in a place": counts over ``facts`` (place, document_id), 0 for unknown places.

    The template is filled for all questions at once and run as one join; only reading is possible.
    """
    place = F.regexp_extract(F.col(question), r"\bin (\p{Lu}[\p{L}-]+)", 1)
    per = facts.groupBy("place").agg(F.countDistinct("document_id").alias("n"))
    return asked.withColumn("place", place).join(per, "place", "left").withColumn("n", F.coalesce("n", F.lit(0))).drop("place")


def parse_reply(c: Column) -> Column:
    """Entities and relationships of a model's reply: fences dropped, else the outermost braces taken; empty lists if it can't be read.

    Entities without a name or of an unknown type are left out; unknown relations become the general one.
    """
    schema = "struct<entities:array<struct<name:string,type:string>>,relationships:array<struct<source_entity:string,relation_type:string,target_entity:string>>>"
    plain = tx.without_fences(c)
    kg = F.coalesce(F.from_json(F.when(F.startswith(plain, F.lit("{")), plain), schema), F.from_json(F.regexp_extract(plain, r"(?s)(\{.*\})", 1), schema))
    empty = F.from_json(F.lit('{"entities":[],"relationships":[]}'), schema)
    entities = F.filter(F.coalesce(kg["entities"], empty["entities"]), lambda e: F.coalesce(F.trim(e["name"]) != "", F.lit(False)) & e["type"].isin(ENTITY_TYPES))
    whole = F.filter(F.coalesce(kg["relationships"], empty["relationships"]), lambda r: r["source_entity"].isNotNull() & r["target_entity"].isNotNull())
    relations = F.transform(whole, lambda r: F.struct(r["source_entity"].alias("source_entity"), tx.safe_relation(r["relation_type"]).alias("relation_type"), r["target_entity"].alias("target_entity")))
    return F.struct(entities.alias("entities"), relations.alias("relationships"))


def critic(answer: Column, context: Column, least: float = 0.5) -> Column:
    """Whether an answer is supported well enough by its context to be given."""
    return F.coalesce(overlap(answer, context) >= least, F.lit(False))


def map_answers(reports: DataFrame, question: str, most: int = 20) -> DataFrame:
    """(community, points, answer): reports that share words with a question, the best ``most``."""
    points = F.size(F.array_intersect(_words(F.lit(question)), _words("text")))
    return reports.select("community", points.alias("points"), F.substring("text", 1, 400).alias("answer")).filter("points > 0").orderBy(F.desc("points"), "community").limit(most)


def reduce_answers(partial: DataFrame, most: int = 10) -> DataFrame:
    """(answer,): the best partial answers as one."""
    best = partial.orderBy(F.desc("points"), "community").limit(most)
    return best.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("points")).alias("p"), "community", "answer"))), lambda x: x["answer"]), "\n").alias("answer"))
