import random
import re
from collections import defaultdict

from lodestrata.llm import site_lines as sl

SCHEMA = "segment_id string, document_id long, municipality_id string, text string, line string, source string"


def brute(rows, min_docs):
    docs, places = defaultdict(set), []
    for seg, doc, muni, text, *_ in set(rows):
        if text is None or muni is None:
            continue
        for i, line in enumerate(text.split("\n")):
            k = re.sub(r"\d+", "#", re.sub(r"\s+", " ", line.lower()).strip())
            if k:
                docs[muni, k].add(doc)
                places.append((seg, i, (muni, k)))
    return {(s, i) for s, i, k in places if len(docs[k]) >= min_docs}


def test_exact_part_equals_brute_force(spark):
    rows = []
    for d in range(12):
        rows.append((f"a{d}", d, "m1", f"© 2020{d} Gemeinde | Impressum\nEigener Satz {chr(97 + d)} hier\n\n  ", "x", None))
        rows.append((f"b{d}", d, "m2" if d % 3 else "m1", "Seite  drucken " + ("(alt)" if d > 9 else ""), "x", None))
    rows += [("n1", 1, None, "© 2020 Gemeinde | Impressum", None, None), ("n2", 2, "m1", None, None, None), ("n3", 3, "m1", "", None, None), ("L", 4, "m1", "wort " * 200_000, None, None)]
    rows += rows[:2]
    df = spark.createDataFrame(rows, SCHEMA)
    found = sl.repeated_lines(df, "segment_id", "document_id", "municipality_id", "text", min_docs=6)
    got = {(r.segment_id, r.line_no) for r in found.filter("line_docs >= 6").collect()}
    assert got == brute(rows, 6) and got
    clean = {r.segment_id: r.clean_text for r in sl.without_lines(df, "segment_id", "text", found).collect()}
    assert clean["a3"] == "Eigener Satz d hier\n\n  " and clean["n2"] is None and clean["n3"] == "" and len(clean) == 28
    assert sl.repeated_lines(df.limit(0), "segment_id", "document_id", "municipality_id", "text").count() == 0


def test_near_duplicates_share_a_cluster(spark):
    rows = [(f"s{d}", d, "m", "Alle Angaben der Gemeinde Musterdorf ohne Gewähr, maßgeblich ist allein die amtliche Bekanntmachung" + (" heute" if d % 2 else ""), None, None) for d in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = sl.repeated_lines(df, "segment_id", "document_id", "municipality_id", "text", min_docs=6).collect()
    assert len(found) == 6 and {r.line_docs for r in found} == {3} and {r.cluster_docs for r in found} == {6}


def test_only_verified_clusters_are_removed(spark):
    """Planted: notices that differ by dates and names, or by one word of a long line; sentences of one pattern stay."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abdeghiklmnoprstuw") for _ in range(7))
    months = ["Januar", "März", "Juni", "Oktober"]
    long_notice = [word() for _ in range(60)]
    rows, planted, body = [], set(), set()
    for d in range(60):
        lines = [f"Zuletzt bearbeitet am {d % 28 + 1}. {rng.choice(months)} 20{10 + d % 9} durch Herr {word().title()}", " ".join(long_notice[:30] + [word()] + long_notice[30:])]
        sentences = [f"Das Gutachten für {word()} wird extern begleitet und {word()} wird {word()} gefördert." for _ in range(4)]
        for i, x in enumerate(lines + sentences):
            (planted if i < 2 else body).add((f"s{d}", i))
        rows.append((f"s{d}", d, "m", "\n".join(lines + sentences), None, None))
    found = {(r.segment_id, r.line_no) for r in sl.repeated_lines(spark.createDataFrame(rows, SCHEMA), "segment_id", "document_id", "municipality_id", "text").collect()}
    assert not found & body
    assert len(found & planted) >= 0.9 * len(planted)


def test_clusters_count_documents_of_their_source_alone(spark):
    text = "Dieser Hinweis steht auf allen Seiten und gilt bis auf weiteres"
    rows = [(f"s{d}", d, f"m{d % 2}", text, None, None) for d in range(10)] + [(f"t{i}", 50, "m0", text, None, None) for i in range(9)]
    found = sl.repeated_lines(spark.createDataFrame(rows, SCHEMA), "segment_id", "document_id", "municipality_id", "text").collect()
    assert {r.municipality_id for r in found} == {"m0"} and {r.cluster_docs for r in found} == {6} and len(found) == 14


def brute_clusters(rows, min_docs):
    """Number of documents of each line's cluster, by all pairs of forms of a source and links followed to the end."""
    forms, places = defaultdict(set), []
    for seg, doc, muni, text, *_ in set(rows):
        for i, line in enumerate(text.split("\n")):
            form = (muni, sl.normal_form(line))
            forms[form].add(doc)
            places.append((seg, i, form))
    of = {}
    for m, k in forms:
        w = re.findall(r"[^\W_]+|[#@]+", sl.masked(k))
        of[m, k] = {tuple(w[i : i + sl.RUN]) for i in range(len(w) - sl.RUN + 1)} or {k}
    group = {f: f for f in forms}

    def root(f):
        return f if group[f] == f else root(group[f])

    keys = sorted(forms)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if a[0] == b[0] and 5 * len(of[a] & of[b]) >= 4 * len(of[a] | of[b]):
                group[root(a)] = root(b)
    docs = defaultdict(set)
    for f in forms:
        docs[root(f)] |= forms[f]
    return {(s, i): len(docs[root(f)]) for s, i, f in places if len(docs[root(f)]) >= min_docs}


def test_all_alike_forms_are_linked(spark):
    """Chains whose ends aren't alike, forms alike another than the most frequent, shares just at and below the threshold, all of one beginning."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abdeghiklmnoprstuw") for _ in range(7))
    rows = []
    for m in ("m1", "m2"):
        texts = []
        for _ in range(10):
            base = [word() for _ in range(rng.randint(12, 70))]
            for step in range(7):
                texts.append(" ".join(base))
                if rng.random() < 0.5:
                    base = base[rng.randint(0, 2) :] + [word() for _ in range(rng.randint(0, 2))]
                else:
                    base = base[:]
                    base[rng.randrange(len(base))] = word()
        # nine runs, eight of them in common: 8 of 10
        begin = [word() for _ in range(12)]
        texts += [" ".join([*begin, word()]) for _ in range(40)]
        # one template, of which five runs of 30 and of 45 differ
        for n in (34, 49):
            frame = [word() for _ in range(n)]
            texts += [" ".join(frame[: n // 2] + [word()] + frame[n // 2 + 1 :]) for _ in range(12)]
        texts += [word() for _ in range(20)]
        rows += [(f"{m}-{d}", d, m, t, None, None) for d, t in enumerate(texts)]
    found = sl.repeated_lines(spark.createDataFrame(rows, SCHEMA), "segment_id", "document_id", "municipality_id", "text", min_docs=3).collect()
    want = brute_clusters(rows, 3)
    assert {(r.segment_id, r.line_no): r.cluster_docs for r in found} == want and max(want.values()) == 40 and len(want) > 150


def test_a_cluster_may_be_spread_over_small_buckets(spark):
    """Six documents, six forms, each alike the next alone."""
    names = [chr(97 + i) * 4 for i in range(40)]
    rows = [(f"s{d}", d, "m", " ".join(names[2 * d : 2 * d + 26]), None, None) for d in range(6)]
    found = sl.repeated_lines(spark.createDataFrame(rows, SCHEMA), "segment_id", "document_id", "municipality_id", "text").collect()
    assert {r.cluster_docs for r in found} == {6} and len({r.cluster for r in found}) == 1 and len(found) == 6
