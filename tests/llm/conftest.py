from __future__ import annotations

import pytest

from ledgerloom.llm.common import prepare

# Columns that operators might use themselves.
CLASHING = ("row", "label", "kept", "fp", "shard", "hash", "_row", "contaminated", "bits", "ids", "x", "at")
LONG = "the quick brown fox jumps over a lazy dog and " * 4000 + "fin"

ROWS = [
    (0, "The first text, with  white \t space."),
    (1, None),
    (2, ""),
    (3, "The first text, with white space."),
    (4, LONG),
    (5, LONG),
    (5, LONG),  # a repeated row
    (5, "another text with the same id"),
    (None, "no id"),
    (None, "no id"),
    (None, None),
    (9, "日本語 é ß <|endoftext|> 😀 \x00 idiot"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeats, missing ids, and columns with clashing names."""
    prepare(spark)
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["?"] * len(CLASHING)) for r in ROWS], schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
