import random

import pytest
from pyspark.sql import functions as F

from lodestrata.config import Config
from lodestrata.models import offline
from lodestrata.operators import graph, joins, merge, passages
from lodestrata.sources import fetch, html, wiki
from lodestrata.streaming import jobs


def test_insert_ignore_and_upsert(spark):
    target = spark.createDataFrame([(1, "old", 0)], "k int, v string, t int")
    rows = spark.createDataFrame([(1, "new", 1), (2, "a", 2), (2, "b", 1), (2, "b", 1)], "k int, v string, t int")
    first = {(r.k, r.v) for r in merge.insert_ignore(target, rows, ["k"], ["t"]).collect()}
    last = {(r.k, r.v) for r in merge.upsert(target, rows, ["k"], ["t"]).collect()}
    assert first == {(1, "old"), (2, "b")} and last == {(1, "new"), (2, "a")}
    assert merge.delete_missing(target, rows.limit(0), ["k"]).count() == 0


def test_numbering_over_partitions(spark):
    keys = [f"k{i:04}" for i in range(997)]
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    assert {r.k: r.rn for r in passages.numbered(df, "k").collect()} == {k: i + 1 for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("n,last", [(45, 7), (10, 10)])
def test_range_shards(spark, n, last):
    df = spark.createDataFrame([(i,) for i in range(n)], "k int")
    sizes = {r["shard"]: r["count"] for r in passages.range_shards(df, "k", 20).groupBy("shard").count().collect()}
    assert sizes[19] == last and all(v == 2 for k, v in sizes.items() if k != 19)


def test_within_places_equals_brute_force(spark):
    r = random.Random(2)
    rows = [(d, r.randrange(40)) for d in range(3) for _ in range(30)]
    a = spark.createDataFrame(rows, "d int, x int").withColumn("i", F.monotonically_increasing_id())
    b = a.select("d", F.col("x").alias("y"), F.col("i").alias("j"))
    got = joins.within_places(a, b, "d", "x", "y", 3).count()
    assert got == sum(p[0] == q[0] and abs(p[1] - q[1]) <= 3 for p in rows for q in rows)


def test_communities_and_components(spark):
    edges = [(f"{g}{i}", f"{g}{j}", 1) for g in "abc" for i in range(6) for j in range(i)] + [("a0", "b0", 1), ("b1", "c1", 1)]
    e = spark.createDataFrame(edges, "src string, dst string, weight long")
    m = graph.communities(e)
    groups = {}
    for r in m.collect():
        groups.setdefault(r.community, set()).add(r.node)
    assert sorted(map(len, groups.values())) == [6, 6, 6]
    assert graph.modularity(e, m).first().modularity > 0.5
    assert graph.components(e).select("component").distinct().count() == 1
    assert {r.node: r.depth for r in graph.within_hops(graph.undirected(e), spark.createDataFrame([("a1",)], "node string"), 2).collect()}["b0"] == 2


def test_lease_states_agree(spark):
    r = random.Random(5)
    kinds = list(jobs.KINDS.values())
    rows = []
    for job in range(12):
        t = 1_700_000_000
        for i in range(40):
            t += r.choice([5, 60, 1000])
            rows.append((job, t, r.choices(kinds, [5, 3, 3, 1, 1])[0], i, r.choice("ab")))
    df = spark.createDataFrame(rows, "job long, t long, kind string, id long, worker string").withColumn("ts", F.timestamp_seconds("t"))
    want = {}
    for job in range(12):
        s = jobs.START
        for _, t, kind, _, worker in sorted((x for x in rows if x[0] == job), key=lambda x: (x[1], x[3])):
            s = jobs.step(s, kind, worker, float(t))
        want[job] = s
    assert {x.job: tuple(x)[1:] for x in jobs.final_states(df).collect()} == want
    assert {s[1] for s in want.values()} == {"a", "b"} and len({s[0] for s in want.values()}) > 1


def test_html_page():
    one, two = "Eine Überschrift mit mehr als dreißig Zeichen", "Noch eine, darunter, mit ebenso vielen Zeichen"
    p = html.read(
        f"<html><head><title> T </title><meta name='author' content='A'><meta property='og:title' content='O'></head><body><nav><p>Menü {'x' * 40}</p><a href='/menu'>m</a></nav><h1>{one}</h1><h2>kurz</h2><p>kurz<p>"
        + "Ein langer Absatz mit Text &amp; mehr. " * 2 + f"<h2>{two}</h2><ul><li>Punkt mit genug Zeichen darin, ja.</li></ul><script>var a='</p>'</script>"
        "<a href='/x'>Link <b>Text</b></a><a href='//b.example//y//z#s'>Y</a><a href='../x'>nochmal</a><a href='t.jpg?1'>b</a><a href='tel:1'>t</a><a href='#o'>o</a><a href='ftp://c.example'>f</a></body></html>",
        "https://a.example/s/t.html",
    )
    assert p.title.strip() == "T" and p.meta == {"author": "A", "og_title": "O"}
    assert p.links == [("https://a.example/x", "Link Text"), ("https://b.example/y/z", "Y")]
    assert [(k, h) for k, _, h in p.segments] == [("heading", None), ("paragraph", one), ("heading", None), ("list_item", f"{one} > {two}")]
    assert html.read(None).segments == []


def test_wiki_entries(spark):
    t = "[[Vor]]\n== Orte ==\n* [[A|a]]\n* [[B]]\n* [[A|x]] [[Datei:z]] [[Liste der C]]\n=== Teil ===\n[[D]]\n== Ende ==\n[[E]]"
    out = wiki.entries(spark.createDataFrame([(1, t), (2, None)], "k int, t string"), "k", "t", "Orte").collect()
    assert {(r.title, r.label) for r in out} == {("A", "a"), ("B", "B"), ("D", "D")}


def test_retries():
    calls, waits = [], []

    def flaky(url):
        calls.append(url)
        return (503, None, None, 7.0) if len(calls) == 1 else (200, "t", b"x", None)

    assert fetch.with_retries(flaky, "u", 3, waits.append) == (200, "t", b"x", None, 2) and waits == [7.0]
    assert fetch.with_retries(lambda u: 1 / 0, "u", 2, waits.append)[3] == "division by zero" and waits[1:] == [0.5]


def test_config():
    assert Config.from_environment({"LODESTRATA_TOP_K": "3", "LODESTRATA_FETCH_DELAY_S": "1.5"}) == Config(top_k=3, fetch_delay_s=1.5)


def test_replies(spark):
    rows = [("```json\n{\"entities\":[{\"name\":\"A\",\"type\":\"Ort\"}],\"relationships\":[]}\n```",), ("no json",), (None,), ("so: {\"entities\":[]} end",)]
    out = spark.createDataFrame(rows, "c string").select(F.size(offline.parse_reply(F.col("c"))["entities"]).alias("n")).collect()
    assert [r.n for r in out] == [1, 0, 0, 0]


def test_fuzzy_candidates_hold_all_alike_names(spark):
    import difflib
    import random

    from lodestrata.plans import models

    r = random.Random(4)
    names = {"barbaar sogometusen", "barbara sgoometusen", "amt", "amtt", "im amt nord", "ab", "a"}
    for _ in range(60):
        w = "".join(r.choice("aabcde n") for _ in range(r.randint(2, 24))).strip() or "x"
        names.add(w)
        for _ in range(3):
            c = list(w)
            for _ in range(r.randint(1, 3)):
                i = r.randrange(len(c))
                c[i : i + 1] = r.choice([[], [c[i], r.choice("abxy")], [r.choice("abxy")]])
                c = c or ["x"]
            names.add("".join(c).strip() or "x")
    rows = [("t", "c", k) for k in names] + [("t", "d", "barbaar sogometusen")]
    got = {(x.category, x.a, x.b) for x in models.fuzzy_candidates(spark.createDataFrame(rows, "entity_type string, category string, k string")).collect()}
    alike = {("c", a, b) for a in names for b in names if a < b and (difflib.SequenceMatcher(None, a, b).ratio() >= 0.85 or a in b or b in a)}
    assert len(alike) > 100 and alike <= got, sorted(alike - got)[:5]
    assert ("c", "barbaar sogometusen", "barbara sgoometusen") in got and all(c == "c" for c, _, _ in got)


def test_best_first_is_a_heap(spark):
    import heapq
    import random

    from lodestrata.operators import graph

    r = random.Random(2)
    edges = sorted({(s, f"n{r.randrange(30)}", f"n{r.randrange(30)}") for s in (1, 2) for _ in range(80)})
    rows = [(*e, hash_of(e[2])) for e in edges]
    seeds = [(1, "n0", 5), (2, "n1", 5)]
    want = set()
    for site, node, priority in seeds:
        heap, seen, place = [(-priority, 0, 0, node)], set(), 0
        while heap and place < 15:
            _, depth, _, x = heapq.heappop(heap)
            if x in seen:
                continue
            seen.add(x)
            place += 1
            want.add((site, x, depth, place))
            for s, a, b, p in rows:
                if s == site and a == x and b not in seen and depth < 4:
                    heapq.heappush(heap, (-p, depth + 1, place, b))
    got = graph.best_first(spark.createDataFrame(rows, "site int, src string, dst string, priority int"), spark.createDataFrame(seeds, "site int, node string, priority int"), 4, 15)
    assert {tuple(x) for x in got.select("site", "node", "depth", "place").collect()} == want


def hash_of(name):
    return int(name[1:]) * 7 % 5
