import numpy as np

from lodestrata.llm import main_body as mb

SCHEMA = "item string, doc long, host string, ord int, kind string, text string, no_context int, label int"


def brute_longest(token, page):
    out = []
    for i in range(len(token)):
        best = 0
        for j in range(len(token)):
            if page[i] != page[j]:
                k = 0
                while max(i, j) + k < len(token) and token[i + k] == token[j + k]:
                    k += 1
                best = max(best, k)
        out.append(best)
    return out


def test_longest_runs_against_brute_force():
    rng = np.random.default_rng(2)
    token = rng.integers(0, 3, 200).astype(np.uint64)
    page = np.repeat(np.arange(10), 20)
    token[60:75] = token[120:135]
    token[19::20] = np.arange(100, 110)
    assert mb.longest_elsewhere(token, page).tolist() == brute_longest(token.tolist(), page.tolist())
    order, levels = mb.suffix_array(token)
    assert order.tolist() == sorted(range(200), key=lambda i: token[i:].tolist())
    assert mb.longest_elsewhere(token[:0], page[:0]).tolist() == []


def test_every_long_run_shares_a_chosen_part():
    rng = np.random.default_rng(3)
    for _ in range(50):
        run = rng.integers(0, 1 << 32, mb.RUN + int(rng.integers(0, 9))).astype(np.uint64)
        a = np.concatenate([rng.integers(0, 1 << 32, int(rng.integers(0, 20))).astype(np.uint64), run, rng.integers(0, 1 << 32, 7).astype(np.uint64)])
        b = np.concatenate([rng.integers(0, 1 << 32, int(rng.integers(0, 20))).astype(np.uint64), run])
        parts = [set(mb.winnowed(x, np.zeros(len(x), dtype=np.int32))[1].tolist()) for x in (a, b)]
        assert parts[0] & parts[1]


def test_covered():
    assert mb.covered(np.array([1, 5]), np.array([2, 9]), 8).tolist() == [False, True, True, False, False, True, True, True]


def test_counts_cover_the_whole_host(spark, monkeypatch):
    """Frame on three of many pages counts the same whether the host's pages share a stream or not."""
    rng = np.random.default_rng(4)
    text = lambda n: " ".join(name(*rng.integers(0, 600, 3)) for _ in range(n))
    notice, title = text(12), text(9)
    rows = []
    for d in range(30):
        rows.append((f"s{d:02}a", d, "h", 0, "paragraph", text(20) + "." + ("\n" + notice + "\n" + text(20) if d % 10 == 0 or d == 5 else ""), 1, None))
        rows.append((f"s{d:02}b", d, "h", 1, "paragraph", notice if d in (3, 14, 22) else title if d < 2 else text(8), 1, None))
    df = spark.createDataFrame(rows, SCHEMA)
    found = []
    for pages in (200, 4):
        monkeypatch.setattr(mb, "PAGES", pages)
        rows = mb.segment_features(df).collect()
        found.append({r.item: (np.frombuffer(r.dense, dtype=np.float16)[:7].tolist(), r.frame_lines) for r in rows})
    assert len(found[0]) == 60 and found[0] == found[1]
    assert found[0]["s00a"][1] == [1] and found[0]["s01a"][1] == [] and found[0]["s14b"][0][3] > 0.6


def test_streams_are_not_moved_for_their_counts(spark, monkeypatch):
    """Where the counts are too large to be sent to every task, they alone are shuffled to the streams."""
    monkeypatch.setattr(mb, "PAGES", 4)
    plans, stage = {}, mb.stage_table

    def staged(df, label, *args, **kwargs):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, label, *args, **kwargs)

    monkeypatch.setattr(mb, "stage_table", staged)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert mb.segment_features(spark.createDataFrame(pages(False), SCHEMA)).count() == 162
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans["page_features"].count("Exchange hashpartitioning") == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("page_streams")]


def name(*n):
    return "".join(chr(97 + x // 26) + chr(97 + x % 26) for x in n)


def pages(label):
    rows = []
    for d in range(40):
        texts = [("Startseite | Rathaus | Kontakt | Suche", 0), (f"Bericht {name(d, d)} und {name(d, 7)}", 1), (" ".join(name(d, i) for i in range(30)) + ".", 1), (f"© 20{d:02} Gemeinde Musterdorf | Impressum", 0)]
        for i, (t, main) in enumerate(texts):
            rows.append((f"s{d:02}-{i}", d, "h" if d % 4 else None, i, "heading" if i == 1 else "paragraph", t, 1, main if label and d % 2 else None))
    rows.append(("null", 99, "h", 0, None, None, 1, None))
    rows.append(("long", 98, "h", 0, None, "viel text " * 100_000, 1, None))
    return rows


def scores(df):
    return mb.main_scores(df.unionByName(df.limit(3)), df.select("item", "label"))


def test_frame_is_told_from_body(spark):
    for label in (True, False):
        out = {r.item: r.main for r in scores(spark.createDataFrame(pages(label), SCHEMA)).collect()}
        assert len(out) == 162 and out["null"] < 0.5
        for d in range(40):
            assert [out[f"s{d:02}-{i}"] >= 0.5 for i in range(4)] == [False, True, True, False]


def test_empty_table(spark):
    assert scores(spark.createDataFrame([], SCHEMA)).count() == 0
