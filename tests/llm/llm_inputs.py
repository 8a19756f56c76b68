"""Small odd inputs that every operator has to take."""

from __future__ import annotations

import pytest

from verity.session import ship_package

CLASHING = "n bigint, cid string, bits string, token int, t string, hash int, salt int, kept string, score string, place int, gone int, n_lines string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): nulls, empty, blank, long, repeated, ties, one very long word."""
    prose = " ".join(f"word{i % 37} and {i % 11}" for i in range(60))
    long = "\n".join(f"line {i} of a very long text with number {i * 7 % 101}" for i in range(12_000))
    return [
        (1, prose, "en", "a"), (2, prose, "en", "b"), (3, prose + " x", None, None), (3, prose + " x", None, None),
        (4, None, "en", "a"), (5, "", "en", "a"), (6, " \t\n\r ", "de", "c"), (7, "one two", "en", "a"), (8, "ONE\ttwo", "en", "b"),
        (None, prose, "en", "c"), (None, None, None, None), (9, long, "en", "d"), (10, "x" * 70_000, "en", "d"),
        (11, "a  b\r\nc", "fr", "e"), (12, "a b c", "fr", "e"), (2, "other text for a repeated id", "en", "b"), (13, "été 中文 😀 ß", "fr", "e"),
    ]


@pytest.fixture(scope="session")
def odd_documents(spark, odd_rows):
    rows = [(*r, len(r[1] or "")) + tuple(None for _ in range(12)) for r in odd_rows]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}").repartition(3)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
