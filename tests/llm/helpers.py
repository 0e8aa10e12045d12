"""Small tables for the operators: odd rows of every kind."""

LONG = "the quick brown fox " * 30_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "One two three four five six.", None, None, 28),
       (3, "One two three four five six.", None, None, 28), (4, "one TWO three four five six.", "en", "a", 28),
       (None, "An id is missing here, mail x.y@example.com now.", "en", "b", 47), (5, LONG, "en", "b", len(LONG)),
       (6, "Grüße, 漢字 кот \u0001 ½ ﬁ e\u0301 🙂", "de", "b", 20), (7, " \n\t ", "de", "b", 4)]


def docs(spark, rows=None):
    return spark.createDataFrame(ODD if rows is None else rows, DOCS)


def table(spark, name, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")
