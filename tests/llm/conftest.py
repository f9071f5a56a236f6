import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, row string, h string, kept string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls everywhere, empty and very long texts, ties, repeated rows and clashing column names."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(20000))
    texts = ["the quick brown fox jumps over the lazy dog", "", None, " \t\n ", long, "the  quick brown fox jumps over the lazy dog", "ein Wort", "a", "A", "x" * 70000]
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else f"src{i}", len(t or ""), "i", "r", None, "k") for i, t in enumerate(texts)]
    rows += [rows[0], rows[4], (None, "the quick brown fox jumps over the lazy dog", None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
