import pytest

from flowwarden.llm.common import ready

LONG = "word " * 60_000

#: doc_id, text, source, and columns that the operators use as names themselves.
EDGES = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one", "b"), (5, "One", "b"), (6, "one two three four", "b"),
    (7, LONG, "a"), (8, LONG, "a"), (9, "x" * 100_000, "é"), (None, "no id here at all now", "b"), (10, "a b c d e f g h", "b"),
    (10, "a b c d e f g h", "b"), (11, "日本語 🤷🏽 <|endoftext|> it's", "Z"),
]
COLUMNS = "doc_id long, text string, source string, size string, hash int, n int, node int, score string, part int, copies int, target string"


@pytest.fixture
def edges(spark):
    ready(spark)
    rows = [(*r, "s", 1, 2, 3, "q", 4, 5, None) for r in EDGES]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture
def nothing(edges):
    return edges.where("false")
