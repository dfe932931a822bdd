import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def table(spark):
    """A small documents-like table with clashing extra columns and repeated rows."""
    def make(rows, schema="doc_id long, text string, source string, lang string, size long, key string, score string, kept string"):
        width = schema.count(",") + 1
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)
    return make
