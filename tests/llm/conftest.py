"""Small tables with what real ones hold: nulls, empty texts, repeated rows, further columns with clashing names."""

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows and ids, and columns that operators use themselves."""
    long = " ".join(f"word{i % 997} the" for i in range(40_000))
    rows = [(1, "The same text.", "en", "a", 14), (2, "The same text.", "en", "a", 14), (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \t\n", "de", "b", 3), (6, long, "en", "a", len(long)), (None, "The same text.", "en", None, 14), (7, "one", "en", "a", 3), (7, "one", "en", "a", 3), (7, "two words", "fr", "c", 9), (-5, "Ünïcödé ﬁ ẞ", "de", "c", 11)]
    df = spark.createDataFrame(rows, COLUMNS)
    from pyspark.sql import functions as F

    clashing = ("h", "k", "fp", "key", "score", "shard", "slot", "kept", "label", "id", "tokens", "topic", "value", "component", "word", "n_words", "position")
    return df.withColumns({c: F.lit(f"own {c}") for c in clashing}).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
