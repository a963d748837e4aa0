"""Answers to questions in one pass over a set of them: route, search, check, and ask again for what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Config
from ..session import stage_table
from . import offline


def _shared(asked: DataFrame, texts: DataFrame, key: str, most: int) -> DataFrame:
    """(qid, key, text, r): the ``most`` texts that share most of each question's longer words, ties by key."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: F.char_length(w) > 3))
    wanted = asked.select("qid", F.explode(words("question")).alias("word"))
    known = wanted.select("word").distinct()
    met = texts.select(key, F.explode(words("text")).alias("word")).join(F.broadcast(known), "word")  # the words of a stated set of questions
    points = met.join(F.broadcast(wanted), "word").groupBy("qid", key).agg(F.count("*").alias("points"))
    best = points.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("points"), key))).filter(F.col("r") <= most)
    return best.join(texts.select(key, "text"), key).select("qid", key, F.substring("text", 1, 400).alias("text"), "r")


def _joined(found: DataFrame) -> DataFrame:
    return found.groupBy("qid").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "text"))), lambda x: x["text"]), "\n").alias("result"))


def answer(questions: DataFrame, passages: DataFrame, reports: DataFrame, config: Config = Config()) -> DataFrame:
    """(qid, route, loops, complete, answer) of questions (qid, question), a stated set of bounded size.

    Local questions are answered by the best passages (segment_id, text), global
    ones by the best reports (community, text), mapped and reduced, and counting
    ones by the number of passages that hold all their longer words. A critic
    checks every answer; what it misses is asked again, ``critic_loops`` times at
    most, and the answers of all rounds are put together.
    """
    spark = questions.sparkSession
    open_ = questions.select("qid", "question", F.col("question").alias("first"))
    rounds = []
    for loop in range(config.critic_loops):
        routed = stage_table(open_.withColumn("route", offline.route(F.col("question"))), "routed")
        of = lambda kind: routed.filter(F.col("route") == kind)  # noqa: E731, B023
        local = _joined(_shared(of("local"), passages, "segment_id", config.top_k))
        overall = _joined(_shared(of("global"), reports, "community", config.communities))
        long_words = F.filter(F.split(F.lower("question"), r"[^\p{L}\p{N}]+"), lambda w: F.char_length(w) > 6)
        counting = of("structured").select("qid", F.filter(long_words, lambda w: ~w.isin("dokumente", "anzahl")).alias("w"))
        held = passages.select("text").join(F.broadcast(counting), F.forall("w", lambda w: F.contains(F.lower("text"), w)))
        counts = counting.join(held.groupBy("qid").agg(F.count("*").alias("n")), "qid", "left").select("qid", F.concat(F.coalesce("n", F.lit(0)).cast("string"), F.lit(" Abschnitte: "), F.array_join("w", " ")).alias("result"))
        found = local.unionByName(overall).unionByName(counts)
        checked = routed.join(found, "qid", "left").withColumn("result", F.coalesce("result", F.lit("")))
        checked = checked.withColumn("complete", (F.col("route") == "structured") | offline.critic(F.col("first"), F.col("result"))).withColumn("loop", F.lit(loop + 1))
        done = stage_table(checked, "answered")
        rounds.append(done)
        missing = F.array_join(F.filter(F.split("first", r"\s+"), lambda w: ~F.contains(F.lower("result"), F.lower(w))), " ")
        open_ = done.filter("not complete").select("qid", missing.alias("question"), "first").filter("question <> ''")
        if open_.isEmpty():
            break
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    together = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("loop", "result"))), lambda x: x["result"]), "\n---\n")
    return out.groupBy("qid").agg(F.min_by("route", "loop").alias("route"), F.max("loop").alias("loops"), F.max("complete").alias("complete"), together.alias("answer"))
