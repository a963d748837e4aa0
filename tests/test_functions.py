import pytest
from pyspark.sql import functions as F

from lodestrata.functions import text, urls


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c")).alias("x")).first().x


@pytest.mark.parametrize(
    "url,want",
    [
        (" HTTPS://WWW.A.de:443//x/../y/?b=2&utm_source=q&A=1#f ", "https://www.a.de/y?A=1&b=2"),
        ("mailto:x@y", ""), ("/rel", ""), ("", ""), (None, ""), ("http://a.de", "http://a.de/"), ("http://a.de:80/b/./c/", "http://a.de/b/c"), ("http://a.de/?x&y=", "http://a.de/?x=&y="),
    ],
)
def test_canonical_url(spark, url, want):
    assert one(spark, url, urls.canonical) == want


@pytest.mark.parametrize(
    "url,want",
    [
        ("https://a.de/x.ZIP", True), ("https://a.de/l?sort=x", False), ("https://a.de/l?page=21", True), ("https://a.de/l?page=20", False), ("https://a.de/kalender/x", False), ("https://a.de/kalender", False),
        ("", True), ("https://a.de/" + "x" * 3000, True), ("https://a.de/l?" + "&".join(["a=1"] * 6), True), ("https://a.de/schule/1", True),
    ],
)
def test_traps(spark, url, want):
    got = one(spark, url, lambda c: urls.is_trap(c, F.lit(0)))
    assert got == (True if "kalender" in url else want)


def test_priorities(spark):
    assert one(spark, "https://a.de/x.pdf", lambda c: urls.priority(c, F.lit(None).cast("string"))) == 310
    assert one(spark, "https://a.de/impressum", lambda c: urls.priority(c, F.lit("Kontakt"))) == -60


def test_segment_score(spark):
    two_hits = "Klima und Solar " + "x" * 984
    assert one(spark, two_hits, text.segment_score) == 54
    assert one(spark, "Impressum " + "y" * 90, text.segment_score) == -80


@pytest.mark.parametrize("name,want", [("Stadtwerke Musterstadt GmbH", "stadtwerke musterstadt"), ("Bund für Umwelt e.V.", "bund umwelt"), ("  ", "")])
def test_entity_norm(spark, name, want):
    assert one(spark, name, text.entity_norm) == want


@pytest.mark.parametrize("value,want", [("kooperiert mit", "KOOPERIERT_MIT"), ("unknown", "BEZIEHT_SICH_AUF"), (" fördert ", "FÖRDERT")])
def test_relations(spark, value, want):
    assert one(spark, value, text.safe_relation) == want


@pytest.mark.parametrize("value,want", [("9162000", "09162000"), ("12", ""), (None, ""), ("09 162 000", "09162000")])
def test_ags(spark, value, want):
    assert one(spark, value, text.ags_norm) == want


@pytest.mark.parametrize("n,want", [(0, None), (600, [(0, 600)]), (601, [(0, 600), (540, 601)]), (1140, [(0, 600), (540, 1140)]), (1141, [(0, 600), (540, 1140), (1080, 1141)])])
def test_token_windows(spark, n, want):
    got = one(spark, ["t"] * n, lambda c: text.token_windows(c, 600, 60), "array<string>")
    assert (None if got is None else [(w.start, w.end) for w in got]) == want


def test_page_pieces(spark):
    assert len(one(spark, "a" * 3000, text.page_pieces)) == 1
    page = "\n\n".join(["b" * 1400] * 4)
    assert [len(x) for x in one(spark, page, text.page_pieces)] == [2802, 2802]
    short = "\n\n".join(["c" * 3100, "d" * 10])
    assert one(spark, short, text.page_pieces) == ["c" * 3100]


def test_joined_urls(spark):
    join = lambda base, href: spark.createDataFrame([(base, href)], "b string, h string").select(urls.join(F.col("b"), F.col("h")).alias("x")).first().x
    base = "https://a.de/x/y?q"
    assert [join(base, h) for h in ("/k", "//b.de/c", "?z", "w", "http://c.de/")] == ["https://a.de/k", "https://b.de/c", "https://a.de/x/y?z", "https://a.de/x/w", "http://c.de/"]
