import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Nulls in every column, empty and blank texts, repeated ids and rows, a very long text.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
    (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
    (1, "Another text of the same id that is quite unlike the first one", "en", "b", None),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \n\t ", "en", "a", 4),
    (None, "the QUICK brown fox jumps over the lazy dog again and again", "en", None, 5),
    (None, None, None, None, None),
    (5, "one two three", "en", "b", 1),
    (6, "ONE two three", "en", "b", 1),
    (7, "write to me@example.org or 10.0.0.1 é ü\nline\nline\n", "de", "c", 1),
    (8, " ".join(f"w{i}" for i in range(60_000)), "en", "c", 1),
    (9, "x" * 200_000, "en", "c", 1),
]


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def odd(make):
    return make(ODD).cache()


@pytest.fixture(scope="session")
def none(make):
    return make([])


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with columns of names that the operators use themselves."""
    names = ("row", "n", "size", "start", "key", "id", "kept", "host", "n_words", "digest", "component", "tokens", "doc")
    from pyspark.sql import functions as F

    return odd.select("*", *(F.lit(7).alias(n) for n in names))
