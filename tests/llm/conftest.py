import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names clash with the operators'."""

    def documents(*rows):
        full = [(i, t, "row", 1, "fp", 2.0) for i, t in rows]
        return spark.createDataFrame(full, "doc_id bigint, text string, row string, n_words int, kept string, score double")

    return documents
