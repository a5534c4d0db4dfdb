import duckdb
import pytest

from tests.conftest import SF_SMALL, spark  # noqa: F401

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_small():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture
def make_docs(spark):  # noqa: F811
    """A documents table of ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` rows."""
    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


