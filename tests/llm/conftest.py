import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture
def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, and columns with clashing names."""
    rows = [
        (1, "a b c d e", "x", 1),
        (1, "a b c d e", "x", 1),
        (1, "quite another text under the same id", None, 2),
        (2, None, "x", 3),
        (None, "a text without an id", "x", 4),
        (None, None, None, None),
        (3, "", "y", 5),
        (4, "  \n\t ", "y", 6),
        (5, "word " * 30_000, "y", 7),
        (6, "ÀÉÎ ñandú ß 漢字 🙂", "z", 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, fp int")
