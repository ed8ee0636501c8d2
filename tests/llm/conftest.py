import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, items string, score string, digest string, marks string"


def docs(spark, pairs):
    """Documents with columns whose names clash with those that the operators use inside."""
    return spark.createDataFrame([(i, t, None, None, None, "x", "y", "z", "w", "v") for i, t in pairs], DOCS)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank, very long, repeated and equal texts."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    text = "The quick brown fox jumps over the lazy dog near the quiet river bank at dawn today"
    return docs(spark, [(1, None), (2, ""), (3, " \t\n"), (4, long), (5, text), (5, text), (6, text), (7, text.upper()), (None, text), (None, None), (8, "naïve Ünïcode 漢字 😀"), (9, long + " end")])
