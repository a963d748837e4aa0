import numpy as np

from lodestrata.llm import reading


def one(text):
    return {k: int(v[0]) for k, v in reading.count_texts([text]).items()}


def test_counts_of_plain_sentences():
    c = one("Der Hund schläft im Garten. Die Familie isst heute zusammen Kuchen.")
    assert (c["sentences"], c["words"]) == (2, 11)
    assert c["letters"] == 55 and c["long"] == 3


def test_frame_lines_are_left_out_and_wrapped_lines_are_joined():
    c = one("Startseite | Kontakt\nDas ist der erste Satz hier. Das ist der zweite.\n© 2022 Impressum")
    assert (c["sentences"], c["words"]) == (2, 10)
    c = one("Der Bericht der Ver-\nwaltung ist lang und\nwird im Rat gelesen und\nim Ausschuss beraten.")
    assert (c["sentences"], c["words"]) == (1, 15)


def test_abbreviations_and_dates_end_no_sentence():
    assert one("Z. B. sinkt der Anteil am 17. Januar 2024 auf 75 Prozent, wie es heißt.")["sentences"] == 1


def test_empty_null_and_long_texts():
    for t in (None, "", "  \n ", "123 456"):
        assert one(t)["words"] == 0
    long = "Das Haus ist alt. " * 300_000
    many = reading.count_texts([None, long, "Ein Satz mit fünf Wörtern."])
    assert many["sentences"].tolist() == [0, 300_000, 1] and many["words"].tolist() == [0, 1_200_000, 5]


def test_cut_divides():
    x, level = np.array([1.0, 2, 3, 10, 11, 12]), np.array([1, 1, 1, 2, 2, 2])
    assert 3 < reading._cut(x, level, 1) < 10


def test_levels_follow_labels(spark):
    plain = "Das Haus ist alt. Wir gehen heim. Der Hund ist da. "
    hard = (
        "Die haushaltsrechtlich gebotene Fortschreibungsplanung konkretisiert die Inanspruchnahme der Gebäudekoordinierungsmaßnahme, "
        "nachdem die Verwaltungsvorlage unter Berücksichtigung der Koordinierungsstrategie angepasst werden soll. "
    )
    rows = [(i, plain * (i + 1), "x") for i in range(5)] + [(10 + i, hard * (i + 1), "y") for i in range(5)] + [(20, None, "z"), (21, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, level string")
    labels = spark.createDataFrame([(i, "r", 1) for i in range(5)] + [(10 + i, "r", 4) for i in range(5)] + [(20, "r", None)], "doc_id long, rater string, level int")
    out = {r.doc_id: r.level for r in reading.reading_levels(docs, labels).collect()}
    assert all(out[i] == 1 for i in range(5)) and all(out[10 + i] == 4 for i in range(5))
    assert out[20] is None and out[21] is None
    assert all(r.level is None for r in reading.reading_levels(docs, labels.limit(0)).collect())
