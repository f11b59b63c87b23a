import pytest


@pytest.fixture()
def docs_of(spark):
    """A documents table of (doc_id, text) pairs, with the other columns and a
    few extra ones whose names clash with those of the operators."""

    def make(rows):
        full = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t), "x", 7, 1) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, key string, n long, component int")

    return make


@pytest.fixture()
def vocab():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path
