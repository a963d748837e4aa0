import itertools
import random
import re

import numpy as np

from lodestrata.llm import golay, near_dup

SCHEMA = "segment_id string, document_id long, text string, cls long, key string"


def test_golay_code_is_perfect():
    w = np.arange(1 << 23, dtype=np.int32)[:: 97]
    m = golay.decode(w)
    check, _ = golay._tables()
    distance = np.bitwise_count(w ^ (m << golay.CHECK | check[m]))
    assert distance.max() == 3


def test_words_two_errors_apart_share_an_index():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 1 << 23, 300, dtype=np.int64)
    i, j = rng.integers(0, 23, (2, 300))
    v = w ^ (1 << i) ^ np.where(i == j, 0, 1 << j)
    of = lambda x: [set() for _ in x]
    a, b = of(w), of(v)
    for sets, x in ((a, w), (b, v)):
        for r, k in zip(*golay.neighbour_indices(x)):
            sets[r].add(int(k))
    assert all(x & y for x, y in zip(a, b)) and max(map(len, a)) == 6


def brute(rows, k, threshold, min_chars):
    sets = {}
    for seg, doc, text, *_ in rows:
        if text and len(text) >= min_chars:
            w = re.findall(r"[^\W_]+", text.lower())
            if len(w) >= k:
                sets[seg] = (doc, {tuple(w[i : i + k]) for i in range(len(w) - k + 1)})
    out = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        (da, sa), (db, sb) = sets[a], sets[b]
        j = len(sa & sb) / len(sa | sb)
        if da != db and j >= threshold:
            out[a, b] = j
    return out


def made(seed):
    r = random.Random(seed)
    vocabulary = [f"wort{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = [r.choice(vocabulary) for _ in range(r.randint(40, 90))]
        rows.append((f"s{i:03}", i, " ".join(words), 1, "x"))
        copy = words[:]
        for _ in range(r.choice([0, 1, 2])):
            copy[r.randrange(len(copy))] = "neu"
        if r.random() < 0.5:
            copy = ["Vorab", "gilt"] + copy
        rows.append((f"t{i:03}", i + r.choice([0, 1000]), " ".join(copy), 2, None))
    rows += [("n1", 1, None, 3, None), ("n2", 2, "", 3, None), ("n3", 3, "x" * 5000, 3, None), ("n4", 4, "kurz " * 2, 3, None)]
    rows += [("L1", 5, "lang " * 50_000 + "ende", 3, None), ("L2", 6, "lang " * 50_001 + "ende", 3, None)]
    return rows + rows[:3]


def test_pairs_against_brute_force(spark):
    rows = made(4)
    df = spark.createDataFrame(rows, SCHEMA)
    members, links = near_dup.near_duplicates(df, "segment_id", "document_id", "text", k=3, threshold=0.6, min_chars=100)
    got = {(r.a, r.b) for r in near_dup.item_pairs(members, links).collect()}
    true = brute(rows, 3, 0.6, 100)
    assert got <= true.keys()
    assert all(j < 0.75 for p, j in true.items() if p not in got) and len(got) >= 0.95 * len(true)
    labels = {r.item: r.label for r in near_dup.group_labels(members, links).collect()}
    assert all(labels[a] == labels[b] for a, b in got)
    assert len(labels) == len({r[0] for r in rows if r[2] and len(r[2]) >= 100 and len(r[2].split()) >= 3})


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    members, links = near_dup.near_duplicates(df, "segment_id", "document_id", "text")
    assert near_dup.item_pairs(members, links).count() == 0 and near_dup.group_labels(members, links).count() == 0


def test_hot_keys_lose_no_pair(spark):
    """One long notice in all texts puts them under common keys; of those only the true pairs may come out, all of them."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghiklm") for _ in range(8))
    notice = [word() for _ in range(40)]
    rows = []
    for i in range(30):
        own = [word() for _ in range(50)]
        rows += [(f"a{i:02}", 2 * i, " ".join(own + notice), 1, None), (f"b{i:02}", 2 * i + 1, " ".join(own[:-2] + notice), 1, None)]
    base = near_dup.classes(spark.createDataFrame(rows, SCHEMA), "segment_id", "document_id", "text", 3)
    of = {x.cls: x.item for x in base.collect()}
    pairs = {tuple(sorted((of[x.a], of[x.b]))) for x in near_dup.candidate_pairs(base, 3, 0.6, meet=5).collect()}
    true = set(brute(rows, 3, 0.6, 0))
    assert true <= pairs and len(true) == 30
    sets = near_dup._shingle_sets(base.dropDuplicates(["cls"]), 3)
    rare = {tuple(sorted((of[x.a], of[x.b]))) for x in near_dup.rare_pairs(sets, 0.6).collect()}
    assert true <= rare and len(rare) < 200
