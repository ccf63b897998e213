import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def folder(spark, tmp_path):
    """Writes tables to a folder that the queries read."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, empty and blank texts, a very long text, repeated rows, equal texts."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t", None, "a", 3), (3, long_text, "en", None, None), (4, "one two three", "fr", "b", 13), (4, "one two three", "fr", "b", 13), (5, "one two three", "en", "b", 13), (6, None, "en", "b", None), (7, "😀 é \x00 1", "de", "c", 7)]
    return spark.createDataFrame(rows, DOCS)
