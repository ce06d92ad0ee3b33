import pytest

import __spark_entry__ as entry
from tests import compare
from tidemark.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_same_rows_as_the_sql(spark, name):
    con = compare.connect(FOLDER)
    assert compare.difference(queries.queries()[name](spark, FOLDER), con, queries.oracle_sql()[name]) is None


def test_all_are_registered():
    names = [name for name in entry.queries() if name.startswith("op")]
    assert [int(name[2:].split("_")[0]) for name in names] == list(range(1, 14))
    assert "pipeline" in entry.queries() and queries.oracle_sql().items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name, table", [("op2_token_counts", "documents"), ("op4_rendezvous_sharding", "documents"), ("op5_sentence_span_dedup", "documents"), ("op6_pfair_mixing", "documents"), ("op9_language_id", "documents"), ("language_id_of_pages", "pages")])
def test_a_row_for_each_row_of_the_table(spark, name, table):
    found = queries.queries()[name](spark, FOLDER)
    rows = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    key = found.columns[0]
    assert sorted(r[0] for r in found.select(key).collect()) == sorted(r[0] for r in rows.select(key).collect())
