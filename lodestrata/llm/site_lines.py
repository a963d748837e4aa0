"""Lines repeated across the documents of one source.

A line's normal form is lower-cased and trimmed, with each run of white space as
one blank and each run of digits as ``#``; for clustering, dates, addresses and
titled names are masked as well. Two forms of one
source are linked if their masked lines' sets of runs of five words (of a shorter
line, the line itself) agree in at least ``ALIKE`` of their union; a cluster is
all that links reach, and no link is left out:

1. forms of equal sets are one node, and are never compared;
2. runs are ordered by the number of the source's sets that hold them. Two sets
   that are linked have one in common among the rarest n - ceil(``ALIKE`` n) + 1
   of each, n being a set's size, so all links join on these; where the common run
   stands in both orders bounds what they can have in common;
3. the sets of a run are first compared with one of them, and links followed; then
   those that this didn't reach are compared with all sets of the run in other
   clusters. So a notice in very many forms costs as many comparisons as it has
   forms. All comparisons are verified on the whole sets;
4. a cluster counts by the distinct documents of its forms.

Counts of documents combine on the map side, and a run is gathered with the
distinct sets that hold it: a source that holds a third of all rows, or a line
that stands in every document, is never gathered in one task.

Rows with a null source or text have no lines here; empty lines never count;
duplicate rows count once.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_table, stage_table
from . import near_dup, words

#: Words of a run; least share of runs in common.
RUN, ALIKE = 5, 0.8
_MONTHS = "januar|februar|märz|april|mai|juni|juli|august|september|oktober|november|dezember|january|february|march|may|june|july|october|december"
_DIGITS = re.compile(r"\d+")
_DATE = re.compile(rf"#\.? (?:{_MONTHS})(?: #)?|#\.#\.#|#-#-#|#/#/#")
_ADDRESS = re.compile(r"\S+@\S+|https?://\S+|www\.\S+")
_TITLE = re.compile(r"\b(?:herr|frau|dr\.|prof\.|mr\.?|mrs\.?|ms\.?) (?:dr\. |prof\. )?[^\W\d_][\w-]*(?: [^\W\d_][\w-]*)?")


def normal_form(line: str) -> str:
    """The form under which lines count as the same; white space is all that Unicode knows, U+00A0 included."""
    return _DIGITS.sub("#", " ".join(line.lower().split()))


def masked(normal: str) -> str:
    """Normal form with dates, addresses and titled names masked, for clustering."""
    x = _DATE.sub("#", normal) if "#" in normal else normal
    if "@" in x or "://" in x or "www." in x:
        x = _ADDRESS.sub("@", x)
    return _TITLE.sub("@", x) if "rr " in x or "frau " in x or ". " in x or "mr" in x or "ms" in x else x


LINES = "item string, doc long, source string, line_no int, h long, g long, node long, runs array<long>"


def line_sets(texts: list[str], sources: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the sets, ends of the sets, sets): of each masked line, the hashes of its distinct runs of ``RUN`` words; those of different sources have none in common."""
    word, _, _, bounds = words.word_hashes(texts, extra="#@")
    run, _, offs = words.shingle_hashes(word, bounds, RUN)
    none = np.diff(offs) == 0
    short = np.flatnonzero(none)
    run = np.insert(run, offs[:-1][short], np.array([xxhash.xxh64_intdigest(texts[i].encode("utf-8", "surrogatepass")) for i in short], dtype=np.uint64))
    offs = offs + np.concatenate([[0], np.cumsum(none)])
    of_source = {x: xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in set(sources)}
    run = words.mix(run ^ np.repeat(np.array([of_source[x] for x in sources], dtype=np.uint64), np.diff(offs)))
    owner = np.repeat(np.arange(len(texts)), np.diff(offs))
    order = np.lexsort((run, owner))
    owner, run = owner[order], run[order]
    new = np.ones(len(run), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (run[1:] != run[:-1])
    ends = np.zeros(len(texts) + 1, dtype=np.int32)
    np.cumsum(np.bincount(owner[new], minlength=len(texts)), out=ends[1:])
    sets = run[new]
    node = np.array([xxhash.xxh3_64_intdigest(sets[i:j].tobytes()) for i, j in zip(ends[:-1], ends[1:])], dtype=np.uint64)
    # 40 bits tell runs apart where several of them must agree, and take less room
    return node.view(np.int64), ends, (sets >> np.uint64(24)).view(np.int64)


def lines_of(df: DataFrame, item: str, doc: str, source: str, text: str) -> DataFrame:
    """``LINES`` of every line that isn't blank; ``h`` and ``g`` are 128 bits that stand for its normal form, ``node`` for its source and runs."""

    def run(batches):
        for batch in batches:
            at, number, form_of = [], [], []
            seen: dict[tuple[str, str], int] = {}
            for i, (source, t) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                for n, line in enumerate(t.split("\n")):
                    form = normal_form(line)
                    if form:
                        at.append(i)
                        number.append(n)
                        form_of.append(seen.setdefault((source, form), len(seen)))
            digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for _, x in seen), dtype=">i8").astype(np.int64).reshape(-1, 2)
            node, ends, sets = line_sets([masked(x) for _, x in seen], [x for x, _ in seen])
            of = pa.array(form_of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(at, pa.int64())) for c in range(3)), pa.array(number, pa.int32()),
                 *(pa.array(x).take(of) for x in (digest[:, 0], digest[:, 1], node)), pa.ListArray.from_arrays(pa.array(ends), pa.array(sets)).take(of)],
                names=[x.split()[0] for x in LINES.split(", ")],
            )

    rows = df.select(F.col(item).cast("string").alias("item"), F.col(doc).cast("long").alias("doc"), F.col(source).cast("string").alias("source"), F.col(text).alias("t"))
    return rows.filter(F.col("source").isNotNull() & F.col("t").isNotNull()).mapInArrow(run, LINES)


_FORM = ["source", "h", "g"]


def _first_runs(sets: DataFrame) -> DataFrame:
    """(run, node, size, at): the runs of a set (node, runs) on which its links join, and their places in the order from the rarest."""
    # of different sets, smaller ones can't agree in that share
    several = sets.filter(F.size("runs") >= ALIKE / (1 - ALIKE) - 1e-9)
    each = several.select("node", F.size("runs").alias("size"), F.explode("runs").alias("run"))
    # a run of one set alone comes before all others, but joins nothing
    common = each.withColumn("n", F.count("*").over(Window.partitionBy("run"))).filter("n > 1")
    shared = common.groupBy("node").agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("n", "run"))).alias("of"))
    alone = F.col("size") - F.size("of")
    n_first = F.col("size") - _least("size") + 1 - alone
    first = shared.filter(n_first > 0).select("node", "size", alone.alias("alone"), F.posexplode(F.slice("of", F.lit(1), n_first.cast("int"))))
    return first.select("col.run", "node", "size", (F.col("alone") + F.col("pos")).alias("at"))


def _least(size: str, share: float = ALIKE) -> F.Column:
    return F.ceil(share * F.col(size) - 1e-9)


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets agree in at least ``ALIKE``."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("runs").alias("own")), "a").join(sets.select(F.col("node").alias("b"), F.col("runs").alias("theirs")), "b")
    # the filter stays behind one projection, so that the sets are intersected once
    common = both.select("a", "b", F.struct(F.size(F.array_intersect("own", "theirs")).alias("n"), (F.size("own") + F.size("theirs")).alias("m")).alias("c"))
    return common.filter(F.col("c.n") >= ALIKE * (F.col("c.m") - F.col("c.n")) - 1e-9).select("a", "b")


def _reached(links: DataFrame) -> DataFrame:
    """(node, label): of each set with a link, the least node that links reach."""
    linked = links.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    return near_dup.group_labels(linked.withColumn("item", F.col("cls")), links).select(F.col("cls").alias("node"), "label")


def line_clusters(sets: DataFrame) -> DataFrame:
    """(node, label) of every set (node, runs) that is linked to another; those of a cluster have the same label."""
    rows = stage_table(_first_runs(sets), "line_first_runs")
    may = (F.least("size", "other_size") >= ALIKE * F.greatest("size", "other_size") - 1e-9) & (
        F.least(F.col("size") - F.col("at"), F.col("other_size") - F.col("other_at")) >= ALIKE / (1 + ALIKE) * (F.col("size") + F.col("other_size")) - 1e-9
    )
    one = rows.groupBy("run").agg(F.count("*").alias("n"), F.min(F.struct("size", "node", "at")).alias("one")).filter("n > 1")
    one = one.select("run", *(F.col(f"one.{c}").alias(f"other_{c}") for c in ("size", "node", "at")))
    met = rows.join(one, "run").filter((F.col("node") != F.col("other_node")) & may)
    links = stage_table(_links(met.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b")).distinct(), sets), "line_links")
    label = stage_table(_reached(links), "line_labels")
    # what the first comparisons didn't reach, of runs whose sets lie in several clusters
    rows_now = rows.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = rows_now.groupBy("run").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(F.struct("size", "node", "label")).alias("one")).filter("lo < hi")
    left = stage_table(rows_now.join(mixed.select("run", F.col("one.label").alias("main")), "run").withColumn("rest", F.col("label") != F.col("main")), "line_left", replaces=rows)
    # of two sets the smaller needs fewer of its runs
    small = left.filter(F.col("at") <= F.col("size") - _least("size", 2 * ALIKE / (1 + ALIKE)))
    other = left.select("run", *(F.col(c).alias(f"other_{c}") for c in ("node", "size", "at", "label")), F.col("rest").alias("other_rest"))
    smaller = F.struct("size", "node") < F.struct(F.col("other_size").alias("size"), F.col("other_node").alias("node"))
    meet = lambda a, b: a.join(b, "run").filter((F.col("label") != F.col("other_label")) & smaller & may).select(F.col("node").alias("a"), F.col("other_node").alias("b"))
    met = meet(small.filter("rest"), other).unionByName(meet(small.filter("not rest"), other.filter("other_rest"))).distinct()
    more = stage_table(_links(met, sets), "line_links")
    drop_table(left)
    return label if more.isEmpty() else stage_table(_reached(links.unionByName(more)), "line_labels", replaces=label)


def clustered_forms(lines: DataFrame, min_docs: int) -> DataFrame:
    """(source, h, g, line_docs, cluster, cluster_docs) of the forms in clusters of at least ``min_docs`` documents.

    ``lines`` has (source, doc, h, g, node, runs); ``cluster`` is the least node
    of the cluster.
    """
    sets = stage_table(lines.select("node", "runs").dropDuplicates(["node"]), "line_runs")
    clusters = line_clusters(sets)
    drop_table(sets)
    places = stage_table(lines.select(*_FORM, "node", "doc").distinct(), "line_places")
    forms = places.groupBy(*_FORM, "node").agg(F.count("*").alias("line_docs"))
    label = stage_table(forms.join(clusters, "node", "left").select(*_FORM, "line_docs", F.coalesce("label", "node").alias("cluster")), "line_clusters")
    of = ["source", "cluster"]
    size = label.groupBy(*of).agg(F.count("*").alias("n_forms"), F.sum("line_docs").alias("most")).filter(F.col("most") >= min_docs)
    several = label.join(size.filter("n_forms > 1"), of)
    counted = places.select(*_FORM, "doc").join(several.select(*_FORM, "cluster"), _FORM).select(*of, "doc").distinct().groupBy(*of).agg(F.count("*").alias("cluster_docs"))
    single = size.filter("n_forms = 1").select(*of, F.col("most").alias("cluster_docs"))
    big = counted.unionByName(single).filter(F.col("cluster_docs") >= min_docs)
    return label.join(big, of).select(*_FORM, "line_docs", "cluster", "cluster_docs")


def repeated_lines(df: DataFrame, item: str, doc: str, source: str, text: str, min_docs: int = 6) -> DataFrame:
    """(item, line_no, source, cluster, cluster_docs, line_docs) of each line in a cluster of at least ``min_docs`` documents.

    ``line_docs`` counts the documents of the source with the same normal form,
    ``cluster_docs`` those with any line of the cluster.
    """
    lines = stage_table(lines_of(df, item, doc, source, text), "lines")
    found = clustered_forms(lines, min_docs)
    return (
        lines.select("item", "line_no", *_FORM)
        .join(found, _FORM)
        .select(F.col("item").alias(item), "line_no", F.col("source").alias(source), "cluster", "cluster_docs", "line_docs")
        .distinct()
    )


def without_lines(df: DataFrame, item: str, text: str, found: DataFrame, out: str = "clean_text") -> DataFrame:
    """(item, clean_text): texts without the lines of ``found``; a text of nothing else becomes empty, a null stays null."""
    drop = found.groupBy(item).agg(F.collect_set("line_no").alias("_drop"))
    kept = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("_drop", i))
    return (
        df.select(item, text)
        .dropDuplicates([item])
        .join(drop, item, "left")
        .select(item, F.when(F.col("_drop").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias(out))
    )
