from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, ledger string, h long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns of odd names."""

    def make(rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", "y", 7) for r in rows
        ]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture
def odd_rows():
    """NULLs in every place, blank, repeated and long texts."""
    prose = " ".join(f"w{i}" for i in range(60))
    return [
        (1, prose),
        (2, prose),
        (2, prose),
        (None, prose),
        (3, None),
        (4, ""),
        (5, " \n\t "),
        (6, "one two"),
        (7, "x" * 50_000),
        (8, " ".join(f"v{i}" for i in range(30_000)), None),
    ]


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string, host string, w string")

    return make


