"""Registered queries of this subpackage: SQL twins, and rows as their contracts say."""

import pytest

from pageprism.llm.queries import ORACLES, QUERIES
from tests.oracle import compare

SF = "/root/testdata/sf0.001"
#: Queries with one row per document.
PER_DOCUMENT = sorted(n for n in QUERIES if n.split("_")[0] in ("op2", "op4", "op5", "op6", "op7", "op9", "op10", "op12", "op13"))


def test_entry_registers_all():
    import __spark_entry__ as entry_file

    assert set(QUERIES) | {"pipeline"} <= set(entry_file.queries())
    assert set(ORACLES) <= set(QUERIES)
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, oracle):
    assert compare(QUERIES[name](spark, SF), oracle, ORACLES[name]) is None


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(name, spark):
    want = sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()) == want


def test_rows_of_pieces_and_queries(spark):
    docs = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in QUERIES["op3_packing"](spark, SF).select("doc_id").collect()} == docs
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = QUERIES["op8_topk"](spark, SF).collect()
    assert len(rows) == 5 * vectors.where("vec_id % 50 = 0").count() and all(r.query_id % 50 == 0 for r in rows)
