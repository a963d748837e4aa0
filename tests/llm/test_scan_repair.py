import difflib
import itertools
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestrata.llm import scan_repair as sr


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=7), max_size=25), st.text("abc", min_size=1, max_size=7), st.integers(0, 2))
def test_automaton_finds_every_word_within_distance(words, query, errors):
    got = dict(sr.Trie(set(words)).within(query, errors))
    assert got == {w: distance(query, w) for w in set(words) if distance(query, w) <= errors}


@settings(max_examples=300, deadline=None)
@given(st.text("abcdefg", min_size=1, max_size=12), st.integers(0, 12), st.text("abcdefg", max_size=2), st.text("abcdefg1|", min_size=1, max_size=2))
def test_every_misreading_asks_a_shard_of_its_word(x, at, was, got):
    word, odd = x[:at] + was + x[at:], x[:at] + got + x[at:]
    if len(odd) >= 2 and word and odd != word and distance(odd, word) <= min(2, len(odd) - 1):
        assert set(sr.asked_keys(odd)) & set(sr.shard_keys(word))


def test_look_ups_against_brute_force(spark):
    """Words of two letters and more, misread at any place."""
    r = random.Random(3)
    vocabulary = sorted({"".join(r.choice("abcdeinrstu") for _ in range(r.choice([2, 3, 3, 4, 5, 7, 9]))) for _ in range(300)} | {"die", "und", "im", "Erna"})
    odd = {"d1e", "u0d", "1m", "Ema"}
    for w in vocabulary[::3]:
        at = r.randrange(len(w))
        odd.add(w[:at] + r.choice("01|c") + w[at + r.choice([1, 1, 2]) :])
    odd = sorted(w for w in odd if len(w) >= 2 and w not in vocabulary)
    found = sr.candidates(spark.createDataFrame([(w, 1) for w in odd], "odd string, odd_n long"), spark.createDataFrame([(w, 1) for w in vocabulary], "word string, n long"))
    true = set()
    for o in odd:
        for w in vocabulary:
            got, was = sr.difference(o, w)
            if len(got) <= 2 and len(was) <= 2 and got.lower() != was.lower() and distance(o, w) <= min(2, len(o) - 1):
                true.add((o, w))
    assert {(x.odd, x.word) for x in found.collect()} == true and {("d1e", "die"), ("u0d", "und"), ("1m", "im"), ("Ema", "Erna")} <= true


def test_running_heads_of_a_long_document():
    """Thirty chapters with a running head each; all are found, and the same in a short document."""
    heads = ["Kapitel über " + w for w in ("Wasserwerke Straßen Brücken Schulen Wälder Märkte Friedhöfe Brunnen Sportplätze Museen Archive Bäder Theater Kliniken Mühlen".split())]
    pages = [[h, f"Ein Satz nur für {chr(97 + i)}{h[-3:]} und Seite {k}", "Ende des Textes " + h[-4:] * (i + 2)] for k, h in enumerate(heads) for i in range(3)]
    assert sr.furniture(pages) == [{0}] * len(pages)
    assert sr.furniture(pages[:3]) == [{0}] * 3


def test_furniture_and_broken_words():
    pages = [["Gemeinde A – Bericht über das Netz", "Der Text be-", "ginnt hier und die Klima-", "und Energieziele " + "xyz"[i - 1] * 9, "■ .", f"Seite {i} von 3"] for i in (1, 2, 3)]
    frame = sr.furniture(pages)
    assert frame == [{0, 4, 5}] * 3
    assert sr.broken("Der Text be-", "ginnt hier") and not sr.broken("die Klima-", "und Energie") and not sr.broken("die CO2-", "Bilanz")
    kinds = [(p, i) for p, i, k, *_ in sr.read_document(pages) if k == "hyphen"]
    assert kinds == [(0, 1), (1, 1), (2, 1)]
    assert sr.reflow(pages[:1], {"beginnt": "begann"}) .splitlines()[0].startswith("Gemeinde")


VOCABULARY = ["Verwaltung", "Haushalt", "Sitzung", "Beschluss", "Gemeinde", "Planung", "Vertrag", "Satzung", "Bericht", "Antrag", "Wasser", "Energie"]
SCHEMA = "item string, doc long, ord int, text string, line_no string"


def test_misread_words_are_found(spark):
    r = random.Random(1)
    clean = [("c%d" % i, 0, 0, " ".join(r.choice(VOCABULARY) for _ in range(60)), None) for i in range(20)]
    pages, true = [], set()
    for d in range(30):
        for p in range(2):
            lines = [f"Amt Musterstadt Jahresbericht Teil {'abcdefghij'[d % 10] * 3}"]
            for i in range(1, 9):
                words = [r.choice(VOCABULARY) for _ in range(8)]
                k = r.randrange(1, 7)
                if "e" in words[k][1:-1] and r.random() < 0.6:
                    at = words[k].index("e", 1)
                    words[k] = words[k][:at] + "c" + words[k][at + 1 :]
                    true.add((f"p{d}-{p}", i, "glyph"))
                lines.append(" ".join(words))
            pages.append((f"p{d}-{p}", d, 100 * p, "\n".join([*lines, f"- {p + 1} -"]), None))
    rows, fixes = sr.repair(spark.createDataFrame(pages + pages[:2], SCHEMA).dropDuplicates(["item"]), spark.createDataFrame(clean, SCHEMA))
    got = {(x.item, x.line_no, x.kind) for x in sr.marked_lines(rows, fixes).collect()}
    assert {x for x in got if x[2] == "glyph"} == true
    assert {x for x in got if x[2] == "furniture"} == {(i, n, "furniture") for i, *_ in pages for n in (0, 9)}
    text = {x.doc: x.text for x in sr.paragraphs(spark.createDataFrame(pages, SCHEMA), rows, fixes).collect()}
    assert set(" ".join(text.values()).split()) == set(VOCABULARY)


def test_empty_and_odd_texts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    rows, fixes = sr.repair(empty, empty)
    assert sr.marked_lines(rows, fixes).count() == 0 and sr.paragraphs(empty, rows, fixes).count() == 0
    odd = spark.createDataFrame([("a", 1, 0, "", None), ("b", 1, 100, "\n\n  ", None), ("c", None, None, "-\n-", None), ("d", 2, 0, "wort " * 100_000, None)], SCHEMA)
    rows, fixes = sr.repair(odd, odd)
    assert {(x.item, x.line_no) for x in sr.marked_lines(rows, fixes).collect()} == {("c", 0), ("c", 1)}
