import pytest


@pytest.fixture
def make_docs(spark):
    """Rows (doc_id, text) as a table of documents with extra, clashing columns."""
    def _make(rows, parts=3):
        full = [(i, t, None, "s", None if t is None else len(t), "x", 1) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "group_size string, key int").repartition(parts)
    return _make
