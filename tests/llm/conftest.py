import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, node long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, and columns whose names clash with the operators' own."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
    same = "alpha beta gamma delta " * 20
    rows = [
        (1, "The quick brown fox jumps over the lazy dog", "en", "a", 1, "x", 1), (2, None, None, None, None, None, None), (3, "", "en", "a", 0, "y", 2),
        (4, long, "en", "b", 9, None, 3), (5, same, "en", "b", 9, "z", 4), (6, same, None, None, 9, "z", 4), (6, same, None, None, 9, "z", 4),
        (None, "text without an id", "en", "a", 5, None, None), (7, " \t\n ", "en", None, 4, None, None), (8, "12 34", "en", "c", 5, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
