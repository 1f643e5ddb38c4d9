import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table of documents from texts, ids from 0, with extra columns whose names clash with those of the operators."""

    def make(texts, ids=None):
        rows = [(i if ids is None else ids[i], text, "en", "src0", i, i, "x") for i, text in enumerate(texts)]
        columns = "doc_id long, text string, lang string, source string, n_chars long, n_words long, size string"
        return spark.createDataFrame(rows, columns)

    return make
