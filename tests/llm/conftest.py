import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of texts, or of (doc_id, text); with columns whose names the operators use themselves."""

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        df = spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], DOCS)
        return df.selectExpr("*", "1 AS digest", "'x' AS kinds", "2 AS row", "'y' AS sequence_id")

    return make


@pytest.fixture(scope="session")
def real():
    """(doc_id, text) of the smallest given documents table."""
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
