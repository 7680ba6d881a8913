import pytest

EDGES = [
    (1, None), (2, ""), (3, " \n "), (4, "one"), (5, "a b c"), (5, "a b c"), (6, "A b  C"), (None, "null id text with some words in it"), (7, "word " * 30_000), (8, "é😀 ñ"), (9, "x" * 200_000),
    (10, " " * 1_000_000), (11, "\n" * 1_000_000), (12, "7" * 1_000_000), (13, "\t" * 1_000_000 + "a"),
]


@pytest.fixture
def edges(spark):
    """Nulls in any column, empty and very long texts, repeated rows, and extra columns with clashing names."""
    rows = [(i, t, "n", 1.5, None) for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, tile double, base string")


@pytest.fixture
def empty(edges):
    return edges.limit(0)

