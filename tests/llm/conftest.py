import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) pairs -> documents with the columns of the table."""
    return lambda rows: spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], SCHEMA)
