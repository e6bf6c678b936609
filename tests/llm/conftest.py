from __future__ import annotations

import os

import pytest

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, a clashing extra column."""
    long_text = " ".join(f"word{i % 977}x{i % 89}" for i in range(200_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "x"),
        (2, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "x"),
        (2, "the quick brown fox jumps over the lazy dog", "en", "a", 43, "x"),
        (3, None, None, None, None, None),
        (None, "the quick brown fox jumps over the lazy dog", "en", None, 43, None),
        (4, "", "en", "a", 0, "x"),
        (5, " \t\n", "de", "b", 3, "x"),
        (6, "one two", "en", "b", 7, "x"),
        (7, "ONE  two", "en", "b", 8, "x"),
        (8, long_text, "en", "b", len(long_text), "x"),
        (9, long_text, None, "c", len(long_text), "x"),
        (10, "12345 !!!", "en", "c", 9, "x"),
        (None, None, None, None, None, None),
    ]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, component_id string")
