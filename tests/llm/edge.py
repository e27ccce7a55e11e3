"""Small documents with every awkward case: nulls in each column, blank and long texts, copies, clashing columns."""

from pyspark.sql import Row

LONG = " ".join(f"word{i % 977} tail," for i in range(12_000))
NAMES = ["doc_id", "text", "lang", "source", "n_chars", "ids", "runs", "pii", "fp", "root", "score", "row", "host", "rule"]


def documents(spark, texts=()):
    given = [
        (1, "The quick brown fox jumps over the lazy dog. " * 4, "en"), (2, None, "en"), (3, "", None), (4, " \t\n ", "en"),
        (5, "one", None), (5, "one", None), (None, "no id here at all, but words enough to count", "en"),
        (None, None, None), (6, LONG, "en"), (7, "Der schnelle Fuchs springt über den faulen Hund und läuft davon.", "de"),
        (8, "Der schnelle Fuchs springt über den faulen Hund und läuft davon.", "de"), (9, "12345 67890 !!! ###", "en"),
        (10, "ŁÓDŹ straße İKK ﬁ \u0000 nul   line ", "pl"), (11, "a\nb\na\nb\n\n\nb", "en"),
        *[(100 + i, t, "en") for i, t in enumerate(texts)],
    ]
    rows = [Row(**dict(zip(NAMES, (i, t, lang, None if i == 1 else "s", None if t is None else len(t), "x", "x", "x", "x",
                                   "x", "x", "x", "x", "x")))) for i, t, lang in given]
    types = ["long", "string", "string", "string", "long"] + ["string"] * 9
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(NAMES, types)))


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
