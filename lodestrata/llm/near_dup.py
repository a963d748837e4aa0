"""Near-duplicate texts by Golay-code fuzzy hashing.

A text's similarity to another is the share of their distinct word sequences
(shingles) that both have. Texts are found in four steps:

1. Fingerprints. Each of ``ANCHORS`` hash functions picks one run of
   ``ANCHOR_WORDS`` words (the least hash), and the words around it give a
   46-bit simhash: two segments of 23 bits. Small edits elsewhere leave it alone,
   edits nearby flip few bits.
2. Keys. Each segment is decoded to its neighbouring Golay codewords, one to six
   indices; with up to five errors in 46 bits one segment has at most two, so
   that both texts share one of its indices (pigeonhole). A key is the anchor,
   the segment's number and the index. Anchors of a single text give no keys.
3. Join on the keys, between classes of equal texts, with a 64-bit min-hash
   sketch that drops pairs far below the threshold (four standard deviations).
4. Verification on the exact shingle sets.

Exact copies form one class (64-bit hash of the text) and are never compared
with each other. Counts of anchors combine on the map side. The classes of a key
that more than ``MEET`` have, as of a notice in very many texts, don't all meet:
they are joined by their rarest shingles, which finds every pair that reaches
the threshold and few others. Null texts, texts shorter than
``min_chars`` and texts of fewer words than a shingle take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table
from . import golay, words

ANCHORS, ANCHOR_WORDS, AROUND = 16, 10, 6
#: Texts of at most so many words also give anchors of one shingle each.
SHORT_WORDS = 15
SKETCH = 64
#: Classes of a key that all meet; larger keys are joined another way.
MEET = 64


def _simhash(word: np.ndarray, lo: np.ndarray, hi: np.ndarray, bits: int) -> np.ndarray:
    """Simhash of the words from lo to hi, for each row."""
    size = hi - lo
    offs = np.concatenate([[0], np.cumsum(size)[:-1]])
    h = words.mix(word[np.repeat(lo - offs, size) + np.arange(size.sum())] ^ words.K2)
    out = np.zeros(len(lo), dtype=np.int64)
    for q in range(bits):
        ones = np.add.reduceat(((h >> np.uint64(q)) & np.uint64(1)).astype(np.int32), offs)
        out |= (2 * ones > size).astype(np.int64) << q
    return out


def fingerprints(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of the text, anchor, bits around it) of each anchor; (number of distinct shingles, sketch) of each text."""
    word, _, _, bounds = words.word_hashes([t.lower() for t in texts])
    n_words = np.diff(bounds)
    shingle, _, offs = words.shingle_hashes(word, bounds, k)
    size = np.diff(offs)
    sketch = np.zeros(len(texts), dtype=np.int64)
    some = np.flatnonzero(size > 0)
    if len(some):
        starts = offs[:-1][some]
        for q, s in enumerate(words.seeds(SKETCH)):
            least = np.minimum.reduceat(shingle ^ s, starts) ^ s
            sketch[some] |= ((least >> np.uint64(7)) & np.uint64(1)).astype(np.int64) << q
    rows, anchors, around = [], [], []
    for kind, length, chosen in ((1, ANCHOR_WORDS, n_words >= ANCHOR_WORDS), (2, k, (n_words >= k) & (n_words <= SHORT_WORDS))):
        which = np.flatnonzero(chosen)
        if not len(which):
            continue
        run, at, run_offs = words.shingle_hashes(word, bounds, length)
        starts = run_offs[:-1][which]
        # runs of the chosen texts alone
        member = np.repeat(chosen, np.diff(run_offs))
        run, at = run[member], at[member]
        starts = np.concatenate([[0], np.cumsum(np.diff(run_offs)[which])[:-1]])
        sizes = np.diff(np.append(starts, len(run)))
        for j, s in enumerate(words.seeds(ANCHORS)):
            x = words.mix(run ^ s)
            least = np.minimum.reduceat(x, starts)
            hit = np.flatnonzero(x == np.repeat(least, sizes))
            owner = np.searchsorted(starts, hit, side="right") - 1
            first = np.concatenate([[True], owner[1:] != owner[:-1]])
            place = at[hit[first]]
            lo = np.maximum(place - AROUND, bounds[:-1][which])
            hi = np.minimum(place + length + AROUND, bounds[1:][which])
            rows.append(which)
            anchors.append(words.mix(least ^ np.uint64(97 * kind + j)).view(np.int64))
            around.append(_simhash(word, lo, hi, 2 * golay.BITS))
    empty = np.zeros(0, dtype=np.int64)
    distinct = np.zeros(len(texts), dtype=np.int64)
    if len(shingle):
        owner = np.repeat(np.arange(len(texts)), size)
        order = np.lexsort((shingle, owner))
        o, h = owner[order], shingle[order]
        new = np.concatenate([[True], (o[1:] != o[:-1]) | (h[1:] != h[:-1])])
        distinct += np.bincount(o[new], minlength=len(texts))
    cat = lambda parts: np.concatenate(parts) if parts else empty
    return cat(rows), cat(anchors), cat(around), distinct, sketch


def _fingerprint_rows(base: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            row, anchor, around, size, sketch = fingerprints(batch.column(1).to_pylist(), k)
            cls = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls[row]), pa.array(anchor), pa.array(around), pa.array(sketch[row]), pa.array(size[row].astype(np.int32))],
                names=["cls", "anchor", "around", "sketch", "size"],
            )

    return base.select("cls", "text").mapInArrow(run, "cls long, anchor long, around long, sketch long, size int")


def _keys(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            anchor, around = (batch.column(i).to_numpy() for i in (1, 2))
            rows_out, keys = [], []
            for part in (0, 1):
                row, index = golay.neighbour_indices(around >> golay.BITS * part & (1 << golay.BITS) - 1)
                rows_out.append(row)
                keys.append(words.mix(anchor[row].view(np.uint64) * words.K1 + index.astype(np.uint64) * np.uint64(2) + np.uint64(part)).view(np.int64))
            row = pa.array(np.concatenate(rows_out))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), *(batch.column(i).take(row) for i in (0, 3, 4))], names=["key", "cls", "sketch", "size"])

    return rows.select("cls", "anchor", "around", "sketch", "size").mapInArrow(run, "key long, cls long, sketch long, size int")


def candidate_pairs(base: DataFrame, k: int, threshold: float, meet: int = MEET) -> DataFrame:
    """(a, b), a < b: pairs of classes of ``base`` (cls, text) that share a key and may reach the threshold.

    All classes of a key meet if they are at most ``meet``; those of larger keys
    are joined by their rarest shingles.
    """
    rows = stage_table(_fingerprint_rows(base, k), "fingerprints")
    shared = rows.groupBy("anchor").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("anchor")
    keys = stage_table(_keys(rows.join(shared, "anchor", "left_semi").dropDuplicates(["anchor", "cls"])), "keys", replaces=rows)
    hot = stage_table(keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > meet).select("key"), "hot_keys")
    crowd = None
    if not hot.isEmpty():
        crowd = stage_table(keys.join(hot, "key", "left_semi").select("cls").distinct(), "crowd")
        keys = keys.join(hot, "key", "left_anti")
    a = keys.select("key", *[F.col(c).alias(f"{c}_a") for c in ("cls", "sketch", "size")])
    b = keys.select("key", *[F.col(c).alias(f"{c}_b") for c in ("cls", "sketch", "size")])
    expected = SKETCH * (1 - threshold) / 2
    spread = (SKETCH * (1 - threshold) / 2 * (1 + threshold) / 2) ** 0.5
    near = F.bit_count(F.col("sketch_a").bitwiseXOR(F.col("sketch_b"))) <= int(expected + 4 * spread)
    sizes = (F.col("size_a") >= threshold * F.col("size_b")) & (F.col("size_b") >= threshold * F.col("size_a"))
    pairs = a.join(b, "key").filter((F.col("cls_a") < F.col("cls_b")) & near & sizes).select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"))
    if crowd is not None:
        sets = _shingle_sets(base.join(crowd, "cls", "left_semi").dropDuplicates(["cls"]), k)
        pairs = pairs.unionByName(rare_pairs(stage_table(sets, "crowd_sets"), threshold))
    return pairs.distinct()


def rare_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: every pair of (cls, set) that can reach the threshold, by a common shingle among the rarest of both.

    Two sets that agree in ``threshold`` of their union have one in common among
    the rarest n - ceil(threshold n) + 1 of each, n being its size.
    """
    each = sets.select("cls", F.size("set").alias("size"), F.explode("set").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1")
    # a shingle of one set alone comes before all others, but joins nothing
    ranked = each.join(often, "shingle", "left").withColumn("r", F.row_number().over(Window.partitionBy("cls").orderBy(F.coalesce("n", F.lit(1)), "shingle")))
    first = ranked.filter((F.col("r") <= F.col("size") - F.ceil(threshold * F.col("size") - 1e-9) + 1) & F.col("n").isNotNull())
    first = stage_table(first.select("cls", "size", "shingle"), "rare_shingles")
    a, b = first.withColumnsRenamed({"cls": "a", "size": "sa"}), first.withColumnsRenamed({"cls": "b", "size": "sb"})
    return a.join(b, "shingle").filter((F.col("a") < F.col("b")) & (F.col("sa") >= threshold * F.col("sb")) & (F.col("sb") >= threshold * F.col("sa"))).select("a", "b").distinct()


def _shingle_sets(base: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            word, _, _, bounds = words.word_hashes([t.lower() for t in batch.column(1).to_pylist()])
            shingle, _, offs = words.shingle_hashes(word, bounds, k)
            # sorted and distinct within each text
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offs))
            order = np.lexsort((shingle, owner))
            o, h = owner[order], shingle[order]
            new = np.concatenate([[True], (o[1:] != o[:-1]) | (h[1:] != h[:-1])]) if len(o) else np.zeros(0, dtype=bool)
            ends = np.zeros(batch.num_rows + 1, dtype=np.int32)
            np.cumsum(np.bincount(o[new], minlength=batch.num_rows), out=ends[1:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(h[new].view(np.int64)))], names=["cls", "set"])

    return base.select("cls", "text").mapInArrow(run, "cls long, set array<long>")


def similar_classes(base: DataFrame, k: int, threshold: float) -> DataFrame:
    """(a, b, similarity): pairs of classes with at least ``threshold`` of shingles in common, by exact sets."""
    pairs = stage_table(candidate_pairs(base, k, threshold), "candidates")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = stage_table(_shingle_sets(base.join(needed, "cls", "left_semi").dropDuplicates(["cls"]), k), "shingles")
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("cls").alias("b"), F.col("set").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    # the filter stays behind one projection, so that the sets are intersected once
    return (
        both.select("a", "b", F.struct(common.alias("n"), (F.size("sa") + F.size("sb")).alias("m")).alias("c"))
        .select("a", "b", (F.col("c.n") / (F.col("c.m") - F.col("c.n"))).alias("similarity"))
        .filter(F.col("similarity") >= threshold)
    )


def classes(df: DataFrame, item: str, group: str, text: str, k: int, min_chars: int = 0) -> DataFrame:
    """(item, grp, cls, text) of each distinct row that takes part; ``cls`` stands for the text."""
    return (
        df.filter(F.col(text).isNotNull() & (F.char_length(text) >= min_chars))
        .select(F.col(item).alias("item"), F.col(group).alias("grp"), F.xxhash64(text).alias("cls"), F.col(text).alias("text"))
    )


def near_duplicates(df: DataFrame, item: str, group: str, text: str, k: int = 5, threshold: float = 0.8, min_chars: int = 0) -> tuple[DataFrame, DataFrame]:
    """(members, links).

    members: (item, grp, cls), the class of equal texts of each item with at
    least one shingle; links: (a, b, similarity) between classes, each once.
    """
    base = classes(df, item, group, text, k, min_chars)
    links = stage_table(similar_classes(base, k, threshold), "links")
    enough = F.size(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))) >= k
    members = base.filter(enough).select("item", "grp", "cls").distinct()
    return members, links


def item_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b): pairs of items of different groups in linked classes or in the same class, the smaller item first."""
    m = stage_table(members, "members")
    one = lambda s: m.select(F.col("item").alias(f"item_{s}"), F.col("grp").alias(f"grp_{s}"), F.col("cls").alias(s))
    linked = links.select("a", "b").join(one("a"), "a").join(one("b"), "b")
    several = m.groupBy("cls").agg(F.count("*").alias("n")).filter("n > 1").select("cls")
    own = m.join(several, "cls", "left_semi")
    same = own.select(F.col("item").alias("item_a"), F.col("grp").alias("grp_a"), "cls").join(own.select(F.col("item").alias("item_b"), F.col("grp").alias("grp_b"), "cls"), "cls").filter("item_a < item_b")
    cols = ["item_a", "grp_a", "item_b", "grp_b"]
    return (
        linked.select(*cols)
        .unionByName(same.select(*cols))
        .filter(~F.col("grp_a").eqNullSafe(F.col("grp_b")))
        .select(F.least("item_a", "item_b").alias("a"), F.greatest("item_a", "item_b").alias("b"))
        .distinct()
    )


def group_labels(members: DataFrame, links: DataFrame) -> DataFrame:
    """(item, cls, n_links, label): each item's class, its links to other classes, and the least class reachable over links.

    Labels spread over links and jump to their label's label each round, until
    none changes; every round is a written table that replaces the one before.
    """
    edges = stage_table(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label"), F.count("*").alias("n_links"))
    labels = stage_table(labels.withColumn("moved", F.lit(True)), "labels")
    while not labels.filter("moved").isEmpty():
        seen = edges.join(labels.select(F.col("a").alias("b"), F.col("label").alias("other")), "b").groupBy("a").agg(F.min("other").alias("other"))
        spread = labels.join(seen, "a", "left").select("a", "n_links", "label", F.least("label", F.coalesce("other", "label")).alias("new"))
        jump = spread.join(labels.select(F.col("a").alias("new"), F.col("label").alias("over")), "new", "left")
        to = F.least("new", F.coalesce("over", "new"))
        labels = stage_table(jump.select("a", "n_links", to.alias("label"), (to != F.col("label")).alias("moved")), "labels", replaces=labels)
    named = labels.select(F.col("a").alias("cls"), "n_links", "label")
    return members.join(named, "cls", "left").select("item", "cls", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("label", "cls").alias("label"))
