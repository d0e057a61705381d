import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows with an extra column whose name clashes with the operators' own."""
    def make(rows):
        return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _key string")
    return make


ODD = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "one two"), (4, " \n\t "), (5, "é" * 30_000), (6, "a b c d e f g " * 3_000)]


@pytest.fixture(scope="session")
def odd(docs_of):
    """Nulls, empty and very long texts, repeated rows."""
    return docs_of(ODD)


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of([])
