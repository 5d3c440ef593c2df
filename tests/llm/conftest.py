import pytest


@pytest.fixture(scope="session")
def docs_df(spark):
    """Builds a documents-like frame: (doc_id, text) rows, or longer rows with lang and source."""
    def build(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)
    return build
