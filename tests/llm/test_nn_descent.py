import numpy as np

from lodestrata.llm import nn_descent as nd

SCHEMA = "chunk_id string, embedding array<float>, id string, q int"


def clustered(n, seed=3, dim=16):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((n // 6, dim))
    return np.concatenate([c + 0.15 * rng.standard_normal((6, dim)) for c in centers]).astype(np.float32)


def frame(spark, x):
    rows = [(f"c{i:05}", v.tolist(), "x", i) for i, v in enumerate(x)]
    odd = [("n", None, None, 0), ("z", [0.0] * 16, None, 0), ("s", [1.0] * 15, None, 0), ("m", [float("nan")] + [1.0] * 15, None, 0), ("i", [float("inf")] + [1.0] * 15, None, 0), (None, [1.0] * 16, None, 0)]
    return spark.createDataFrame(rows + odd + rows[:5], SCHEMA)


def brute(x, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return np.argsort(-s, axis=1)[:, :k]


def test_small_collection_is_exact(spark):
    x = clustered(120)
    out = nd.nearest(frame(spark, x), "chunk_id", "embedding", 16, k=5).collect()
    got = {(int(r.chunk_id[1:]), int(r.neighbour[1:])) for r in out}
    true = {(i, int(j)) for i, row in enumerate(brute(x, 5)) for j in row}
    assert len(out) == 600 and len(got & true) >= 597


def test_blocks_and_rounds_reach_recall(spark, monkeypatch):
    monkeypatch.setattr(nd, "MEAN_BLOCK", 100)
    x = clustered(1200)
    out = nd.nearest(frame(spark, x), "chunk_id", "embedding", 16, k=5).collect()
    got = {(int(r.chunk_id[1:]), int(r.neighbour[1:])) for r in out}
    true = {(i, int(j)) for i, row in enumerate(brute(x, 5)) for j in row}
    assert len(got & true) >= 0.95 * len(true)


def test_equal_vectors_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 64)
    x = np.ones((300, 16), dtype=np.float32)
    out = nd.nearest(frame(spark, x), "chunk_id", "embedding", 16, k=5)
    assert out.groupBy("chunk_id").count().filter("count = 5").count() == 300
    assert nd.nearest(frame(spark, x).limit(0), "chunk_id", "embedding", 16).count() == 0


def test_recall_holds_with_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "MEAN_BLOCK", 24)
    x = np.random.default_rng(5).standard_normal((3000, 16)).astype(np.float32)
    out = nd.nearest(frame(spark, x), "chunk_id", "embedding", 16, k=5).collect()
    got = {(int(r.chunk_id[1:]), int(r.neighbour[1:])) for r in out}
    true = {(i, int(j)) for i, row in enumerate(brute(x, 5)) for j in row}
    assert len(got & true) >= 0.9 * len(true), len(got & true) / len(true)


def test_search_finds_queries_of_another_distribution(spark, monkeypatch):
    monkeypatch.setattr(nd, "MEAN_BLOCK", 100)
    x = clustered(6000)
    rng = np.random.default_rng(9)
    vectors = nd.stage_table(nd.unit_vectors(frame(spark, x), "chunk_id", "embedding", 16), "vectors")
    y = np.concatenate([rng.standard_normal((58, 16)), -50 * np.ones((2, 16))]).astype(np.float32)
    asked = nd.unit_vectors(spark.createDataFrame([(str(i), v.tolist()) for i, v in enumerate(y)], "k string, v array<float>"), "k", "v", 16)
    queries = asked.select(asked.key.cast("long").alias("qid"), "q")
    found = nd.search(nd.neighbour_graph(vectors, 16), vectors, queries, 16, beam=12)
    key = {r.id: int(r.key[1:]) for r in vectors.select("id", "key").collect()}
    got = {(r.qid, key[r.id]) for r in found.collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    true = {(i, int(j)) for i, row in enumerate(np.argsort(-(y @ u.T), axis=1)[:, :5]) for j in row}
    assert len(got) == 300 and len(got & true) >= 0.9 * len(true), len(got & true) / len(true)
    assert nd.search(nd.neighbour_graph(vectors.limit(0), 16), vectors.limit(0), queries, 16).count() == 0
