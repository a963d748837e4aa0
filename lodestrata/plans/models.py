"""Queries over the model surfaces with their offline defaults, page and wiki sources, fuzzy resolution and topics."""

from __future__ import annotations

import difflib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..models import offline
from ..functions import lexicon, text
from ..session import stage_table, table
from .catalog import query
from .store import DOCS_SQL, SEG_SQL, chunks, docs, segments


_HITS = f"len(regexp_extract_all(text, '{lexicon.re2(lexicon.POSITIVE)}'))"
_NEG = f"CAST(regexp_matches(text, '{lexicon.re2(lexicon.NEGATIVE)}') AS INTEGER)"


@query("udf_scorer", f"""WITH {SEG_SQL}, f AS (SELECT segment_id, {_HITS} AS hit_count, {_NEG} AS is_negative, least(length(text) // 250, 8) AS bonus FROM seg WHERE text IS NOT NULL)
SELECT segment_id, 25 * hit_count - 80 * is_negative + bonus AS impact_score, hit_count, is_negative FROM f""")
def udf_scorer(spark, sf):
    """Score, hits and negative mark of each segment; any scorer of this form can be plugged in."""
    return segments(spark, sf, text.segment_features(F.col("text")).alias("f"), where="text is not null").select("segment_id", "f.*")


@query("udf_embed")
def udf_embed(spark, sf):
    return offline.embed(chunks(spark, sf, "text"), "chunk_id", "text", 64)


@query("udf_llm_extract")
def udf_llm_extract(spark, sf):
    return offline.extract(table(spark, sf, "segments").filter("text is not null"), "segment_id", "text").distinct()


@query("udf_llm_relations")
def udf_llm_relations(spark, sf):
    return offline.relations(udf_llm_extract(spark, sf), "segment_id")


@query("set_glean_merge")
def set_glean_merge(spark, sf):
    """Entities of two rounds, over texts and over headings."""
    s = table(spark, sf, "segments")
    return offline.merge_rounds(offline.extract(s.filter("text is not null"), "segment_id", "text"), offline.extract(s.filter("heading_context is not null"), "segment_id", "heading_context"), "segment_id")


@query("udf_llm_summary", f"""WITH {SEG_SQL}, t AS (SELECT document_id, substring(text, 1, 200) AS t, row_number() OVER (PARTITION BY document_id ORDER BY coalesce(impact_score, 0) DESC, segment_id) AS r FROM seg)
SELECT document_id, coalesce(array_to_string(list(t ORDER BY r) FILTER (r <= 3), ' '), '') AS summary FROM t GROUP BY 1""")
def udf_llm_summary(spark, sf):
    return offline.summaries(segments(spark, sf, "document_id", "impact_score", "text"), "document_id").select("document_id", "summary")


@query("udf_llm_report", "SELECT s_nationkey AS community, 'Gruppe um ' || min(s_suppkey) || ' (' || count(*) || ')' AS title FROM supplier GROUP BY 1")
def udf_llm_report(spark, sf):
    m = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("community"))
    return offline.reports(m).select("community", "title")


_ROUTE_SQL = "CASE WHEN regexp_matches(lower(title), 'wie viele|anzahl|liste|how many|count') THEN 'structured' WHEN regexp_matches(lower(title), 'überblick|insgesamt|trend|themen|overview|summar') THEN 'global' ELSE 'local' END"


def _titles(spark, sf):
    return table(spark, sf, "documents_raw").select("document_id", F.get_json_object("meta_json", "$.title").alias("title")).filter("title is not null").distinct()


@query("udf_llm_route", f"SELECT DISTINCT document_id, {_ROUTE_SQL} AS route FROM (SELECT document_id, json_extract_string(meta_json, '$.title') AS title FROM documents_raw WHERE meta_json IS NOT NULL) WHERE title IS NOT NULL")
def udf_llm_route(spark, sf):
    return _titles(spark, sf).select("document_id", offline.route(F.col("title")).alias("route")).distinct()


@query("agg_route_counts", f"SELECT route, count(*) AS n FROM (SELECT DISTINCT document_id, {_ROUTE_SQL} AS route FROM (SELECT document_id, json_extract_string(meta_json, '$.title') AS title FROM documents_raw WHERE meta_json IS NOT NULL) WHERE title IS NOT NULL) GROUP BY 1")
def agg_route_counts(spark, sf):
    return udf_llm_route(spark, sf).groupBy("route").agg(F.count("*").alias("n"))


def _words_sql(c):
    return f"list_distinct(list_filter(regexp_split_to_array(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: length(w) > 3))"


def _overlap_sql(a, b):
    return f"CASE WHEN len({_words_sql(a)}) > 0 THEN len(list_intersect({_words_sql(a)}, {_words_sql(b)})) / len({_words_sql(a)}) END"


_CLAIM_SQL = f"list_filter(list_transform(regexp_split_to_array(regexp_replace(substring(text, 1, 600), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: len({_words_sql('x')}) >= 3)[1:10]"
_JUDGE_SQL = f"""{SEG_SQL}, x AS (SELECT segment_id, document_id, heading_context AS q, text FROM seg WHERE heading_context IS NOT NULL AND text IS NOT NULL),
judged AS (SELECT segment_id, document_id, round({_overlap_sql('substring(text, 1, 200)', 'text')}, 4) AS faithfulness, round({_overlap_sql('q', 'text')}, 4) AS recall FROM x)"""


def _judged(spark, sf):
    judged = offline.judge(F.col("heading_context"), F.substring("text", 1, 200), F.col("text")).alias("j")
    return segments(spark, sf, "document_id", judged, where="heading_context is not null and text is not null").select("segment_id", "document_id", "j.*")


@query("udf_llm_judge", f"WITH {_JUDGE_SQL} SELECT segment_id, document_id, faithfulness, recall FROM judged")
def udf_llm_judge(spark, sf):
    return _judged(spark, sf)


@query("udf_llm_claims")
def udf_llm_claims(spark, sf):
    """Claims of each passage's beginning and how many of them its heading's document supports in another passage."""
    s = segments(spark, sf, "document_id", "order_index", "text", where="page_ref is null and text is not null")
    w = Window.partitionBy("document_id").orderBy("order_index", "segment_id")
    s = s.withColumn("context", F.lead("text").over(w)).filter("context is not null")
    return s.select("segment_id", offline.claim_support(F.substring("text", 1, 600), F.col("context")).alias("c")).select("segment_id", "c.*")


@query("agg_eval_avg", f"WITH {_JUDGE_SQL} SELECT round(avg(faithfulness), 6) AS faithfulness, round(avg(recall), 6) AS recall, count(recall) AS n FROM judged")
def agg_eval_avg(spark, sf):
    """Mean scores, rows without a score left out."""
    return _judged(spark, sf).agg(F.round(F.avg("faithfulness"), 6).alias("faithfulness"), F.round(F.avg("recall"), 6).alias("recall"), F.count("recall").alias("n"))


_PAIR_SQL = f"{SEG_SQL}, r AS (SELECT document_id, length(text) AS n, row_number() OVER (PARTITION BY document_id ORDER BY order_index, segment_id) AS k FROM seg), p AS (SELECT a.document_id, a.n AS x, b.n AS y FROM r a JOIN r b ON a.document_id = b.document_id AND a.k = 1 AND b.k = 2)"


@query("join_pairwise_eval", f"WITH {_PAIR_SQL} SELECT document_id, x, y FROM p")
def join_pairwise_eval(spark, sf):
    """First and second answers side by side."""
    from pyspark.sql import Window

    w = Window.partitionBy("document_id").orderBy("order_index", "segment_id")
    r = segments(spark, sf, "document_id", "order_index", F.char_length("text").alias("n")).select("document_id", "n", F.row_number().over(w).alias("k")).filter("k <= 2")
    return r.groupBy("document_id").agg(F.max(F.when(F.col("k") == 1, F.col("n"))).alias("x"), F.max(F.when(F.col("k") == 2, F.col("n"))).alias("y"), F.max("k").alias("m")).filter("m = 2").select("document_id", "x", "y")


@query("agg_winner_tally", f"WITH {_PAIR_SQL} SELECT CASE WHEN x > y THEN 'A' WHEN y > x THEN 'B' ELSE 'tie' END AS winner, count(*) AS n FROM p GROUP BY 1")
def agg_winner_tally(spark, sf):
    return join_pairwise_eval(spark, sf).groupBy(F.when(F.col("x") > F.col("y"), "A").when(F.col("y") > F.col("x"), "B").otherwise("tie").alias("winner")).agg(F.count("*").alias("n"))


_PLACE_SQL = "p AS (SELECT DISTINCT ags, 'Wie viele Dokumente gibt es in ' || name || '?' AS question, regexp_extract(name, '^(\\p{Lu}[\\p{L}-]+)', 1) AS place FROM municipalities WHERE name IS NOT NULL)"


@query("udf_text2query", f"""WITH {DOCS_SQL}, {_PLACE_SQL}, n AS (SELECT regexp_extract(m.name, '^(\\p{{Lu}}[\\p{{L}}-]+)', 1) AS place, count(*) AS n FROM docs d JOIN (SELECT DISTINCT ags, name FROM municipalities WHERE name IS NOT NULL) m ON d.municipality_id = m.ags GROUP BY 1)
SELECT ags, question, coalesce(n, 0) AS n FROM p LEFT JOIN n USING (place)""".replace("\\\\", "\\"))
def udf_text2query(spark, sf):
    """Questions put as structured queries from a template and answered: all questions of a template run as one join."""
    m = table(spark, sf, "municipalities").filter("name is not null").select("ags", "name").distinct()
    asked = m.select("ags", F.concat(F.lit("Wie viele Dokumente gibt es in "), "name", F.lit("?")).alias("question"))
    place = F.regexp_extract("name", r"^(\p{Lu}[\p{L}-]+)", 1)
    facts = docs(spark, sf, "municipality_id").join(m.select(F.col("ags").alias("municipality_id"), place.alias("place")), "municipality_id").select("place", "document_id")
    return offline.counted(asked, "question", facts).select("ags", "question", "n")


QUESTIONS = [(1, "Wie viele Dokumente nennen Klimaschutz?"), (2, "Überblick über Wärmeplan und Klimaschutzkonzept"), (3, "Was steht im Haushaltsplan zur Förderung der Schule?"), (4, "Zzzxq Qqxxz?")]


@query("qa_answers")
def qa_answers(spark, sf):
    """Answers to questions: routed, searched, checked, and asked again for what is missing, at most as often as configured."""
    from ..config import Config
    from ..models import answer

    passages_ = segments(spark, sf, "text", where="text is not null and coalesce(is_negative, 0) = 0")
    return answer.answer(spark.createDataFrame(QUESTIONS, "qid long, question string"), passages_, _district_reports(spark, sf), Config())


@query("set_union_all_questions", f"""SELECT DISTINCT kind, question FROM (SELECT 'local' AS kind, 'Was steht in ' || title || '?' AS question FROM (SELECT json_extract_string(meta_json, '$.title') AS title FROM documents_raw WHERE meta_json IS NOT NULL) WHERE title IS NOT NULL
UNION ALL SELECT 'global', 'Überblick über ' || landkreis FROM municipalities WHERE landkreis IS NOT NULL UNION ALL SELECT 'structured', 'Wie viele Dokumente gibt es in ' || name || '?' FROM municipalities WHERE name IS NOT NULL)""")
def set_union_all_questions(spark, sf):
    """Questions of the three kinds as one set."""
    made = lambda df, kind, before, c, after: df.filter(F.col(c).isNotNull()).select(F.lit(kind).alias("kind"), F.concat(F.lit(before), c, F.lit(after)).alias("question"))
    m = table(spark, sf, "municipalities")
    one = made(_titles(spark, sf), "local", "Was steht in ", "title", "?")
    return one.unionByName(made(m, "global", "Überblick über ", "landkreis", "")).unionByName(made(m, "structured", "Wie viele Dokumente gibt es in ", "name", "?")).distinct()


def _similar(batches):
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])], names=[*batch.schema.names, "ratio"])


def _may_be_alike(batches):
    """Keeps the pairs whose letters, counted in 64 buckets, allow a ratio of 0.85; buckets can only raise the bound."""

    def counts(names: list[str]) -> np.ndarray:
        code = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        of = np.repeat(np.arange(len(names)), [len(n) for n in names])
        return np.bincount(of * 64 + code % 64, minlength=len(names) * 64).reshape(-1, 64)

    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = counts(batch.column("a").to_pylist()), counts(batch.column("b").to_pylist())
        yield batch.filter(pa.array(2 * np.minimum(a, b).sum(axis=1) >= 0.85 * (a.sum(axis=1) + b.sum(axis=1)) - 1e-6))


def fuzzy_candidates(e):
    """(entity_type, category, a, b), a < b: every pair of names ``k`` that can have a ratio of at least 0.85, or of which one holds the other.

    A ratio of 0.85 leaves names of n and m letters at least 0.275 (n + m) - 1
    two-letter sequences in common, counted with repeats, and m >= 0.739 n; so
    the rarest n - ceil(0.478 n - 1) sequences of both have one in common. A
    name that holds another has the rarest three letters of that one, or all of
    it if it is shorter.
    """
    by = ["entity_type", "category"]
    e = e.select(*by, "k", F.char_length("k").alias("len"))
    grams = e.filter("len >= 3").select(*by, "k", "len", F.expr("explode(transform(sequence(1, len - 1), i -> substring(k, i, 2)))").alias("g"))
    grams = grams.withColumn("nth", F.row_number().over(Window.partitionBy(*by, "k", "g").orderBy("g")))
    often = grams.groupBy(*by, "g", "nth").agg(F.count("*").alias("n"))
    ranked = grams.join(often, [*by, "g", "nth"]).withColumn("r", F.row_number().over(Window.partitionBy(*by, "k").orderBy("n", "g", "nth")))
    first = stage_table(ranked.filter(F.col("r") <= F.col("len") - F.ceil(F.col("len") * 0.478 - 1.001)).select(*by, "g", "nth", "k", "len"), "fuzzy_grams")
    left = first.withColumnsRenamed({"k": "a", "len": "la"})
    right = first.withColumnsRenamed({"k": "b", "len": "lb"})
    near = left.join(right, [*by, "g", "nth"]).filter("a < b and la >= 0.739 * lb and lb >= 0.739 * la").select(*by, "a", "b")
    near = near.mapInArrow(_may_be_alike, near.schema)
    parts = e.select(*by, "k", "len", F.expr("explode(array_distinct(flatten(transform(sequence(1, least(len, 3)), q -> transform(sequence(1, len - q + 1), i -> substring(k, i, q))))))").alias("g"))
    parts = stage_table(parts, "fuzzy_parts")
    own = parts.filter(F.char_length("g") == F.least("len", F.lit(3))).join(parts.groupBy(*by, "g").agg(F.count("*").alias("n")), [*by, "g"])
    own = own.groupBy(*by, "k", "len").agg(F.min(F.struct("n", "g")).alias("rarest")).select(*by, F.col("k").alias("short"), F.col("len").alias("ls"), F.col("rarest.g").alias("g"))
    held = own.join(parts, [*by, "g"]).filter(F.col("len") > F.col("ls")).filter(F.contains("k", "short")).select(*by, F.least("k", "short").alias("a"), F.greatest("k", "short").alias("b"))
    return near.unionByName(held).distinct()


@query("join_fuzzy")
def join_fuzzy(spark, sf):
    """Pairs of keys of one type and category alike by matching blocks or containment, of all pairs that can be."""
    e = table(spark, sf, "entity_canonical").select("entity_type", "category", text.entity_norm(F.col("original_name")).alias("k")).filter("k <> ''").distinct()
    r = fuzzy_candidates(e).select("a", "b", "entity_type", "category").mapInArrow(_similar, "a string, b string, entity_type string, category string, ratio double")
    return r.filter((F.col("ratio") >= 0.85) | F.contains("a", "b") | F.contains("b", "a")).withColumn("ratio", F.round("ratio", 4))


@query("fn_similarity")
def fn_similarity(spark, sf):
    """Ratio of matching blocks between each name and its earlier canonical name."""
    e = table(spark, sf, "entity_canonical").filter("canonical_name is not null and original_name is not null").select(F.col("original_name").alias("a"), F.col("canonical_name").alias("b")).distinct()
    return e.mapInArrow(_similar, "a string, b string, ratio double").withColumn("ratio", F.round("ratio", 4))


_STOP = ", ".join(repr(w) for w in lexicon.ARTICLES)
#: Terms of each class (document_type) of documents: runs of one to three words of three letters or more, in at least five and at most 0.95 of the documents.
_TERM_SQL = f"""w AS (SELECT doc_id, document_type AS topic, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda x: length(x) >= 3 AND x NOT IN ({_STOP})) AS w FROM documents WHERE text IS NOT NULL AND document_type IS NOT NULL),
g AS (SELECT doc_id, topic, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS term FROM w WHERE len(w) > 0),
df AS (SELECT term, count(DISTINCT doc_id) AS d FROM g GROUP BY 1), k AS (SELECT term FROM df WHERE d >= 5 AND d <= 0.95 * (SELECT count(*) FROM w)),
t AS (SELECT topic, term, count(*) AS n FROM g WHERE term IN (SELECT term FROM k) GROUP BY ALL), a AS (SELECT sum(n) / count(DISTINCT topic) AS avg_n FROM t), f AS (SELECT term, sum(n) AS f FROM t GROUP BY 1), c AS (SELECT topic, sum(n) AS c FROM t GROUP BY 1),
weight AS (SELECT topic, term, n, round(n / c.c * ln(1 + avg_n / f.f), 8) AS weight FROM t JOIN f USING (term) JOIN c USING (topic), a)"""


def _weights(spark, sf):
    """(topic, term, n, weight) by class-based tf-idf."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda x: (F.char_length(x) >= 3) & ~x.isin(lexicon.ARTICLES))
    d = table(spark, sf, "documents").filter("text is not null and document_type is not null").select("doc_id", F.col("document_type").alias("topic"), words.alias("w"))
    run = lambda k: F.when(F.size("w") >= k, F.transform(F.sequence(F.lit(1), F.size("w") - (k - 1)), lambda i: F.array_join(F.slice("w", i, k), " "))).otherwise(F.array().cast("array<string>"))
    # terms are counted in each document first, so that a document's repeats don't travel
    per_doc = d.select("doc_id", "topic", F.explode(F.concat("w", run(2), run(3))).alias("term")).groupBy("doc_id", "topic", "term").agg(F.count("*").alias("n"))
    per_topic = stage_table(per_doc.groupBy("topic", "term").agg(F.sum("n").alias("n"), F.count("*").alias("d")), "terms")
    most = d.agg((F.count("*") * 0.95).alias("most"))
    kept = per_topic.groupBy("term").agg(F.sum("d").alias("d"), F.sum("n").alias("f")).crossJoin(F.broadcast(most)).filter("d >= 5 and d <= most").select("term", "f")
    t = stage_table(per_topic.select("topic", "term", "n").join(kept, "term"), "terms_kept")
    avg = t.agg((F.sum("n") / F.countDistinct("topic")).alias("avg_n"))
    weight = F.round(F.col("n") / F.col("c") * F.log(1 + F.col("avg_n") / F.col("f")), 8)
    return t.join(t.groupBy("topic").agg(F.sum("n").alias("c")), "topic").crossJoin(F.broadcast(avg)).select("topic", "term", "n", weight.alias("weight"))


@query("fn_ctfidf", f"WITH {_TERM_SQL} SELECT topic, term, weight FROM weight")
def fn_ctfidf(spark, sf):
    """Weight of each term for each class of texts."""
    return _weights(spark, sf).select("topic", "term", "weight")


@query("agg_topic_info", f"""WITH {_TERM_SQL} SELECT topic, n_docs, terms FROM (SELECT topic, array_to_string(list(term ORDER BY weight DESC, term), ', ') AS terms FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS r FROM weight) WHERE r <= 10 GROUP BY 1)
JOIN (SELECT topic, count(*) AS n_docs FROM w GROUP BY 1) USING (topic)""")
def agg_topic_info(spark, sf):
    """Documents and the ten weightiest terms of each topic."""
    w = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
    top = _weights(spark, sf).withColumn("r", F.row_number().over(w)).filter("r <= 10")
    terms = top.groupBy("topic").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "term"))), lambda x: x["term"]), ", ").alias("terms"))
    n = table(spark, sf, "documents").filter("text is not null and document_type is not null").groupBy(F.col("document_type").alias("topic")).agg(F.count("*").alias("n_docs"))
    return terms.join(n, "topic").select("topic", "n_docs", "terms")


#: Topics looked for, the least size of one, and the cosine from which two are one.
TOPICS, LEAST_TOPIC, ALIKE_TOPICS = 24, 25, 0.9


@query("udf_topic")
def udf_topic(spark, sf):
    """Topics of chunks by clustering their vectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    usable = chunks(spark, sf, "embedding", where="embedding is not null and size(embedding) = 64 and not exists(embedding, x -> isnan(x))").select("chunk_id", array_to_vector("embedding").alias("features"))
    usable = stage_table(usable, "topic_vectors")
    if usable.limit(TOPICS + 1).count() <= TOPICS:
        return usable.select("chunk_id", F.lit(0).alias("topic"))
    model = KMeans(k=TOPICS, seed=7, maxIter=10).fit(usable)
    found = stage_table(model.transform(usable).select("chunk_id", F.col("prediction").alias("topic")), "topics")
    # the centres are TOPICS vectors; small topics and those alike join the most similar larger one
    sizes = {r.topic: r.n for r in found.groupBy("topic").agg(F.count("*").alias("n")).collect()}
    centres = np.array(model.clusterCenters())
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    to = {}
    for t in sorted(sizes, key=lambda t: (sizes[t], t)):
        larger = [x for x in sizes if (sizes[x], x) > (sizes[t], t)]
        near = max(larger, key=lambda x: centres[t] @ centres[x], default=None)
        if near is not None and (sizes[t] < LEAST_TOPIC or centres[t] @ centres[near] >= ALIKE_TOPICS):
            to[t] = near
    for t in to:
        while to[t] in to:
            to[t] = to[to[t]]
    pairs = F.create_map(*[F.lit(x) for t, u in to.items() for x in (t, u)]) if to else None
    return found if pairs is None else found.withColumn("topic", F.coalesce(pairs[F.col("topic")], F.col("topic")))


def _district_reports(spark, sf):
    """A report text for each municipality from its titles."""
    t = _titles(spark, sf).join(docs(spark, sf, "municipality_id").withColumnRenamed("municipality_id", "community"), "document_id")
    return t.groupBy("community").agg(F.array_join(F.sort_array(F.collect_set("title")), " ").alias("text"))


@query("udf_llm_map")
def udf_llm_map(spark, sf):
    return offline.map_answers(_district_reports(spark, sf), "Klimaschutzkonzept und Wärmeplan")


@query("udf_llm_reduce")
def udf_llm_reduce(spark, sf):
    return offline.reduce_answers(udf_llm_map(spark, sf))


@query("udf_llm_critic", f"WITH {_JUDGE_SQL} SELECT segment_id, coalesce({_overlap_sql('q', 'text')} >= 0.5, false) AS supported FROM x")
def udf_llm_critic(spark, sf):
    """Whether a passage says enough of what its heading asks for."""
    return segments(spark, sf, offline.critic(F.col("heading_context"), F.col("text")).alias("supported"), where="heading_context is not null and text is not null")


@query("udf_llm_compare", f"""WITH {_JUDGE_SQL}, a AS (SELECT segment_id, coalesce({_overlap_sql('q', 'substring(text, 1, 100)')}, 0) AS oa, len({_words_sql('substring(text, 1, 100)')}) AS wa, coalesce({_overlap_sql('q', 'substring(text, 101, 100)')}, 0) AS ob, len({_words_sql('substring(text, 101, 100)')}) AS wb FROM x)
SELECT segment_id, CASE WHEN (oa, wa) > (ob, wb) THEN 'A' WHEN (ob, wb) > (oa, wa) THEN 'B' ELSE 'tie' END AS winner FROM a""")
def udf_llm_compare(spark, sf):
    """Head to head: which of two parts of a passage answers its heading better."""
    winner = offline.compare(F.col("heading_context"), F.substring("text", 1, 100), F.substring("text", 101, 100))
    return segments(spark, sf, winner.alias("winner"), where="heading_context is not null and text is not null")


@query("fn_vec_pack", "SELECT vec_id, len(embedding) * 4 AS n_bytes, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total FROM embeddings")
def fn_vec_pack(spark, sf):
    """Vectors as bytes of 32-bit floats and back; the sums are those of what came back."""

    def pack(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.asarray(v, dtype="<f4").tobytes() for v in batch.column(1).to_pylist()], pa.binary())], names=["vec_id", "b"])

    def unpack(batches):
        for batch in batches:
            sums = [float(np.frombuffer(b, dtype="<f4").astype(np.float64).sum()) for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(b) for b in batch.column(1).to_pylist()], pa.int64()), pa.array(sums)], names=["vec_id", "n_bytes", "total"])

    packed = table(spark, sf, "embeddings").select("vec_id", "embedding").mapInArrow(pack, "vec_id long, b binary")
    return packed.mapInArrow(unpack, "vec_id long, n_bytes long, total double").withColumn("total", F.round("total", 4))
