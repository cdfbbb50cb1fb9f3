"""The session comes from tests/conftest.py; here are small tables that all operators must stand."""

import pytest

ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the old mill.", "en", "a"),
    (2, "the quick brown fox jumps over the lazy dog near the old mill", None, None),
    (2, "the quick brown fox jumps over the lazy dog near the old mill", None, None),
    (3, None, "en", "b"),
    (4, "", "fr", "b"),
    (None, "text without an id", "en", "b"),
    (5, " \n\t ", None, "b"),
    (6, "word " * 30_000, "en", "c"),
    (7, "x" * 50_000, "en", "c"),
    (8, "Ünïcödé 😀 漢字 \x00 \x85 end", "de", "c"),
    (9, "12345 !!! ...", "de", "c"),
]


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names operators might use."""
    rows = [(*r, len(r[1] or ""), 1, 2, 3, "k") for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id int, part int, rejected int, key string")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (6, 0, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture
def ids(odd):
    return sorted((r[0] is None, r[0] or 0) for r in ODD)
