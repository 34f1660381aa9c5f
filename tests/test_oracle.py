"""Every registered query that SQL can express against DuckDB on the same tables."""

from __future__ import annotations

import os
from pathlib import Path

import compare
import pytest

import __spark_entry__ as contract

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    if not Path(FOLDER).exists():
        pytest.skip("test tables are not here")
    return compare.connect(FOLDER)


#: Queries SQL cannot express; each is compared with a plain version in tests/llm.
WITHOUT_SQL = {
    "pipeline", "op1_ngram_join", "op2_fingerprint", "op3_packing", "op4_pii", "op5_licenses", "op6_toxicity", "op7_token_store", "op8_language",
    "op9_decontamination", "op10_substring_dedup", "op11_simhash", "op12_conversation_repair", "op13_spelling",
}


def test_every_query_has_reference_sql_or_a_plain_version():
    assert set(SQL) <= set(QUERIES) <= set(SQL) | WITHOUT_SQL


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_reference_sql(spark, connection, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), connection, SQL[name]) == []


def test_entry_runs(spark):
    assert contract.entry(spark).limit(1).count() == 1
