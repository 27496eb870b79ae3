"""Queries of the training-data operators that SQL can express, against DuckDB on the same tables."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from ledgermill.llm.queries import LLM_ORACLE, LLM_QUERIES
from tests.compare import differences, open_tables

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not at hand")


@pytest.mark.parametrize("name", list(LLM_ORACLE))
def test_query(spark, name):
    assert differences(LLM_QUERIES[name](spark, SF_DIR), open_tables(SF_DIR), LLM_ORACLE[name]) == []


def test_all_are_registered():
    assert set(LLM_QUERIES) <= set(entry_module.queries())
    assert set(LLM_ORACLE) <= set(entry_module.oracle_sql())
