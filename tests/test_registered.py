"""Every registered query against its SQL twin."""

import zlib

import pytest

import __spark_entry__ as entry_file
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
#: Queries of the training-data subpackage are tested in tests/llm.
QUERIES = {n: q for n, q in entry_file.queries().items() if n != "pipeline" and not n.startswith("op")}
ORACLES = {n: sql for n, sql in entry_file.oracle_sql().items() if n in QUERIES}


def test_names_of_twins():
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, oracle):
    assert compare(QUERIES[name](spark, SF), oracle, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(name, spark):
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_language_profile_is_accurate(spark):
    rows = [r for r in QUERIES["language_profile"](spark, SF).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(r.lang == r.lang_detected for r in rows) / len(rows) > 0.85


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0
