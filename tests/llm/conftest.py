import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def frame(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC).repartition(parts)
    return make


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], DOC)
