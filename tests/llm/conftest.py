import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, row string, __size string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty, blank and long texts, ties, repeated rows, and extra columns with clashing names."""
    long = "The long text goes on and on with words like these. " * 400
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and then it sleeps in the sun for an hour.", "en", "a", 80, 7, "r", "s"),
        (2, "The quick brown fox jumps over the lazy dog and then it sleeps in the sun for an hour.", "en", "a", 80, 7, "r", "s"),
        (2, "The quick brown fox jumps over the lazy dog and then it sleeps in the sun for an hour.", "en", "a", 80, 7, "r", "s"),
        (3, None, None, None, None, None, None, None),
        (None, "Der schnelle braune Fuchs springt über den faulen Hund und schläft dann in der Sonne.", "de", None, 80, 1, "r", "s"),
        (5, "", "en", "b", 0, 2, "", ""),
        (6, " \n\t ", "en", "b", 4, 2, "", ""),
        (7, "12345 --- 67890", None, "b", 15, 2, "", ""),
        (8, long, "en", "c", len(long), 3, "x", "y"),
        (9, long + "end", "en", "c", len(long) + 3, 3, "x", "y"),
        (10, "word", "en", "", 4, 3, "x", "y"),
        (None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
