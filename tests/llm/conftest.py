import pytest

DOCS = "doc_id long, text string, lang string, n_words long, ids string"


@pytest.fixture
def docs(spark):
    """Frames of documents with columns whose names clash with those that operators add."""
    return lambda rows: spark.createDataFrame([(i, t, "en", 7, "x") for i, t in rows], DOCS)
