import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the smallest documents table."""
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


LONG = "one two three four five six seven eight nine ten " * 4000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, line string, words string, rows string, size string"

# nulls in every column, empty and blank texts, one very long text, repeated rows and clashing column names
AWKWARD = [(i, t, lang, src, None, "k", "l", "w", "r", "s") for i, t, lang, src in [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa\nsecond line of this text is here", "en", "a"),
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa\nsecond line of this text is here", "en", "a"),
    (2, None, "en", "a"), (3, "", "de", None), (4, " \t\n\x0b\f\r ", None, None), (5, LONG, "en", "b"), (6, LONG + "end", "en", "b"),
    (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa\nsecond line of this text is here", None, "a"),
    (7, "alpha beta gamma delta epsilon zeta eta theta iota kappa\nsecond line of this text is here", "en", "a"),
    (8, "één woord ▁ \U0001f600 \x00 ​", "fr", "c"), (9, "x", "fr", "c"), (9, "y", "fr", None), (10, "1234 5678", None, "c"),
]]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
