import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from docquarry.session import local_session

    session = local_session(8, "8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def three(spark):
    """Three small documents of mixed types."""
    return spark.createDataFrame(
        [
            ("42", "The social behaviour of many mammals are quite intricated.", ["animals", "biology"], 1, False),
            ("43", "Document 43", ["productivity"], 2, True),
            ("44", "Document 44", ["technology"], 1, False),
        ],
        "_id string, text string, topics array<string>, version long, published boolean",
    )
