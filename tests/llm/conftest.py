from __future__ import annotations

import pytest

from rowsift.functions.runtime import ship

COMMON = "the first quick brown fox jumps over one lazy dog while many others look on from the hill"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Build a documents table from (doc_id, text[, source]) rows, with extra columns of awkward names."""

    def make(rows):
        filled = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), 1, "x", 2) for r in rows]
        return spark.createDataFrame(
            filled,
            "doc_id bigint, text string, lang string, source string, n_chars bigint, pattern int, slot string, lost_keys int",
        )

    return make


@pytest.fixture(scope="session")
def awkward(docs_of):
    """Nulls, empty and very long texts, repeated rows, ties."""
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    return docs_of(
        [
            (1, None),
            (2, ""),
            (3, COMMON),
            (3, COMMON),
            (4, COMMON, None),
            (None, COMMON, None),
            (5, long),
            (6, " \t\n\n \r"),
            (7, "ÄÖ ß\x1cx \x00 😀 İΣ"),
            (8, "a b c", "t"),
            (9, COMMON + "\n" + COMMON, "t"),
        ]
    )


@pytest.fixture(scope="session")
def nothing(docs_of):
    return docs_of([])
