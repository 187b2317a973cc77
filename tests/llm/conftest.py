from __future__ import annotations

import pytest

from hazardlens.llm.common import table


@pytest.fixture(scope="session")
def documents(spark):
    return table(spark, "/root/testdata/sf0.001", "documents")


@pytest.fixture()
def stored(spark, folder):
    """Write rows as a table and read it back."""
    def write(rows, schema: str):
        path = f"{folder}/table"
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    return write


#: Nulls everywhere, empty and very long texts, repeated rows, and columns named like internal ones.
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row_id int, _row_id string, size int"
ODD_ROWS = [
    (1, None, None, None, None, 1, None, 5), (2, "", "en", "a", 0, None, "x", None), (None, "The the", "en", "a", 7, 1, "y", 1),
    (3, "one two three four five six", "en", "a", 27, 1, "y", 1), (3, "one two three four five six", "en", "a", 27, 1, "y", 1),
    (4, "ONE two three four five six", None, None, 27, 1, "y", 1), (5, "É é \n\n x", "fr", "b", 8, 1, "y", 1),
    (6, "word " * 30_000, "en", "b", 150_000, 1, "y", 1), (7, "12 34 !!", "de", "c", 8, 1, "y", 1), (7, None, None, "c", 0, 1, "y", 1),
]
