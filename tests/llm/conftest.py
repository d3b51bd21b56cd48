import pyarrow.parquet as pq
import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def documents():
    """The rows of the smallest documents table, as dictionaries."""
    return pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def made(spark, texts, first=0):
    """A documents table of these texts, with ids from ``first``."""
    return spark.createDataFrame(
        [(first + i, t, "en", "src0", len(t) if t is not None else None) for i, t in enumerate(texts)], DOCUMENTS
    )


@pytest.fixture(scope="session")
def make(spark):
    return lambda texts, first=0: made(spark, texts, first)
