import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, shard string"


@pytest.fixture
def edge(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i % 4001}" for i in range(60_000))
    rows = [
        (1, "The cat sat on the mat and saw a dog", "en", "a", 36, 0.5, "x", "y"),
        (2, None, "en", "a", None, None, None, None),
        (3, "", "en", "b", 0, 0.1, "x", "y"),
        (4, " \t\n ", None, None, 4, 0.1, "x", "y"),
        (5, long, "en", "b", len(long), 0.1, "x", "y"),
        (6, "THE CAT sat on the mat and saw a dog", "en", "c", 36, 0.1, "x", "y"),
        (7, "word", "en", "c", 4, 0.1, "x", "y"),
        (7, "word", "en", "c", 4, 0.1, "x", "y"),
        (None, "word", "en", "c", 4, 0.1, "x", "y"),
        (None, None, None, None, None, None, None, None),
        (8, "naïve café 日本 <|endoftext|> x y", "fr", "c", 30, 0.1, "x", "y"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)
