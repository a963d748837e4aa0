import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm import packing


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_every_item_once_and_within_capacity(sizes):
    out = packing.pack(sizes, 100)
    assert sorted(i for w in out for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= 100 for w in out)


def test_near_the_least_number():
    r = random.Random(3)
    sizes = [min(4095, int(r.lognormvariate(6.5, 0.8)) + 1) for _ in range(1500)]
    out = packing.pack(sizes, 4096)
    assert len(out) <= 1.01 * math.ceil(sum(sizes) / 4096) + 1


def test_differencing_balances():
    items, most = packing.difference([8, 7, 6, 5, 4], 2)
    assert most == 16 and sorted(map(sum, ([[8, 7, 6, 5, 4][i] for i in w] for w in items))) == [14, 16]


def test_rows_of_every_kind(spark):
    rows = [(i, 10 + i % 50, "x") for i in range(200)] + [(500, 0, None), (501, None, None), (502, 1000, None), (503, 100, None), (504, 250, None), (None, 5, None)]
    df = spark.createDataFrame(rows + rows[:9], "doc_id long, n_tokens long, item string")
    out = packing.containers(df, "doc_id", "n_tokens", 100).collect()
    per, size = {}, {}
    for r in out:
        per[r.container] = per.get(r.container, 0) + r.tokens
        size[r.doc_id] = size.get(r.doc_id, 0) + r.tokens
    assert max(per.values()) <= 100 and size == {k: n for k, n, _ in rows if k is not None and n}
    assert sum(r.doc_id == 502 for r in out) == 10 and sum(r.doc_id == 3 for r in out) == 1
    assert packing.containers(df.limit(0), "doc_id", "n_tokens", 100).count() == 0
