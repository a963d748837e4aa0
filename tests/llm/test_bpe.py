import base64

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm import bpe

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def plain():
    with open(bpe.default_vocabulary(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(plain, texts):
    ids, ends = bpe.replay(bpe.default_vocabulary()).encode(texts)
    for i, t in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == (plain.encode_ordinary(t) if t else [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aab \n\t\x1c\x85\xa0 éß漢😀0٣²'st_"), max_size=40), st.text(max_size=30)), max_size=8))
def test_replay_equals_plain_encoder(plain, texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    check(plain, texts)


def test_long_runs_and_special_strings(plain):
    check(plain, ["a" * 3000, " " * 700 + "x", "<|endoftext|>", "aaaa" * 77 + " " + "=" * 333, "", None, "  "])


def test_rows_of_every_kind(spark):
    rows = [(1, "Hallo Welt", "x"), (2, "", "y"), (3, None, "z"), (4, "Hallo Welt", None), (4, "Hallo Welt", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode_corpus(df, "doc_id", "text").collect()
    assert len(out) == 5 and {r.doc_id: len(r.ids) > 0 for r in out} == {1: True, 2: False, 3: False, 4: True}
    assert out[0].ids == out[3].ids
    assert bpe.encode_corpus(df.limit(0), "doc_id", "text").collect() == []
    n = {r.doc_id: r.n_tokens for r in bpe.token_counts(df, "doc_id", "text").collect()}
    assert n[2] == n[3] == 0 and n[1] == len(out[0].ids)
