import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, keep_id string, row string, id string"


@pytest.fixture
def docs(spark):
    """Makes a documents table with extra columns whose names clash with operators' own."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None, "k", None, "r", "x") for i, t in rows], DOCS)

    return make
