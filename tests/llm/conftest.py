import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of the smallest documents table, as a frame and a list."""
    df = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    return df, [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in any column, empty and blank texts, a very long one, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 977}x{i % 1013}" for i in range(60_000))
    rows = [
        (1, None, "en", "a", 1), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", None), (4, long, "en", None, 5),
        (5, long + " end", "en", "a", 5), (None, "a text without an id that is long enough to have words", "en", "a", 7),
        (6, "one", "de", "b", 3), (6, "one", "de", "b", 3), (7, "ONE", "de", "b", 3), (8, "one two three", None, None, None),
        (9, "é" * 300, "fr", "b", 300), (10, "same line\nsame line\nsame line", "en", "a", 29), (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "1 AS n", "'x' AS label", "2 AS node", "'y' AS bucket", "3 AS component", "0 AS place", "'z' AS chunk", "0.5 AS p")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
