import pytest

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, "   \n\t ", "en", None),
    (None, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (6, "short text", None, "b"),
    (7, "short text", "de", "b"),
    (8, "word " * 40_000 + "x" * 50_000 + " 1" * 30_000, "en", "c"),
    (9, "\x00 \x85 é 🙂 ß\x1c\x1f Σ", "fr", "c"),
]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    import __spark_entry__

    spark.sparkContext.addPyFile(__spark_entry__.packed())


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names the operators use inside."""
    rows = [(i, t, lang, source, len(t or ""), "x", 1, "m", [1]) for i, t, lang, source in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, h int, ids string, ranges array<int>").repartition(2)


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("false")
