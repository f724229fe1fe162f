import pytest


@pytest.fixture
def docs_of(spark):
    """A documents table with columns whose names operators use inside."""

    def make(rows):
        schema = "doc_id long, text string, hash long, token string, group string, node long, n int, spans string, blob string, lo int, k long, vector string, kind string, label int"
        return spark.createDataFrame([(i, t, 1, "x", None, 2, 3, "s", "b", 4, 5, "v", "k", 6) for i, t in rows], schema)

    return make


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two three four five six"), (5, "one two three four five six"),
    (6, "a" * 5000), (7, "Größe ½ naïve 日本語 \U0001f600 " * 30), (8, "word " * 20000), (None, "no id here at all today"), (9, None),
]


@pytest.fixture
def odd_rows():
    return list(ODD)
