import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        full = [(i, t, "en", s[0] if s else "src", len(t or "")) for i, t, *s in rows]
        return spark.createDataFrame(full, DOCS)

    return make
