"""The registered queries of the folder over the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from spanloom.llm import queries as llm

SF = "/root/testdata/sf0.001"
#: The table whose rows a query has one of each, where SQL does not say the rows.
ROWS_OF = {
    "op1_embedding_dedup": "embeddings", "op3_simhash_dedup": "documents",
    "op4_quality_rules": "documents", "op5_token_counts": "documents",
    "op7_language_id": "documents", "op8_html_text": "pages",
    "op11_target_resampling": "documents", "op12_piece_encoding": "documents",
}


def test_there_is_one_query_for_each_operator():
    names = [n for n in entry.queries() if n.startswith("op") and "_" in n]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(llm.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_against_sql(spark, name):
    ok, note = compare(spark, connect(SF), SF, name)
    assert ok, note


@pytest.mark.parametrize("name", sorted(ROWS_OF))
def test_one_row_each(spark, name):
    table = spark.read.parquet(f"{SF}/{ROWS_OF[name]}.parquet")
    found = llm.queries()[name](spark, SF)
    key = found.columns[0]
    assert sorted(r[0] for r in found.select(key).collect()) == sorted(
        r[0] for r in table.select(key).collect()
    )
