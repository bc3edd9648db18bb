import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text) pairs; with one source and language unless given."""

    def make(rows, lang="en", source="src1"):
        return spark.createDataFrame(
            [(i, t, lang, source, None if t is None else len(t)) for i, t in rows], DOCS
        )

    return make
