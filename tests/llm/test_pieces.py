import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm import pieces


def check(text, overlap, limit=200, least=60):
    out = pieces.split(text, overlap, limit, least)
    assert out[0][0] == out[0][1] == 0 and out[-1][2] == len(text)
    for (a, _, c), (d, e, f) in zip(out, out[1:]):
        assert e == c and a < d <= c and f > c
    assert all(0 < c - a <= limit for a, _, c in out)
    assert "".join(text[b:c] for _, b, c in out) == text
    return out


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from("ab. \n 😀"), min_size=201, max_size=900), st.integers(-1, 30))
def test_pieces_cover_the_text(text, overlap):
    check(text, overlap)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) + ("." if r.random() < 0.12 else "") for _ in range(n))


def test_overlap_is_the_number_of_words_and_cuts_are_natural():
    text = prose(1, 4000)
    out = check(text, 20, 2000, 600)
    for a, b, _ in out[1:]:
        assert len(text[a:b].split()) == 20
    assert sum(text[c - 2] == "." for _, _, c in out[:-1]) >= 0.9 * (len(out) - 1)


def test_an_edit_alters_only_neighbouring_pieces():
    text = prose(2, 6000)
    other = text[:9000] + "Einschub hier. " + text[9000:]
    a = {text[b:c] for _, b, c in pieces.split(text, 10)}
    b = {other[b:c] for _, b, c in pieces.split(other, 10)}
    assert len(a - b) <= 4 and len(b - a) <= 4


def test_no_boundary_and_very_long():
    assert all(c - a <= 2000 for a, _, c in check("x" * 50_000, 20, 2000, 600))
    check("wort " * 200_000, 20, 2000, 600)


def test_rows_of_every_kind(spark):
    long = prose(3, 1000)
    rows = [("a", long, None, "x"), ("b", "kurz", 5, None), ("c", None, 5, None), ("d", " " * 3000, 5, None), ("e", "   " + "y" * 2000 + "  ", 3, None), ("f", long, 7, None), (None, long, 7, None)]
    df = spark.createDataFrame(rows, "segment_id string, text string, overlap int, piece string")
    out = pieces.split_texts(df, "segment_id", "text", "overlap").collect()
    assert {r.item for r in out} == {"a", "f"}
    shared = [len(r.piece[: r.shared].split()) for r in out if r.item == "f" and r.piece_no]
    assert set(shared) == {7}
    assert pieces.split_texts(df.limit(0), "segment_id", "text", "overlap").count() == 0
