"""The operators' queries against their SQL in DuckDB, over whole tables and over odd rows."""

import duckdb
import pytest

from rateflow.llm.oracle import ORACLE
from rateflow.llm.queries import QUERIES


def same(spark, folder, files, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{files}')")
    found = con.execute(ORACLE[name])
    names = [c[0] for c in found.description]
    ours = QUERIES[name](spark, folder)
    assert sorted(ours.columns) == sorted(names)
    assert sorted(repr(tuple(r)) for r in ours.select(*names).collect()) == sorted(map(repr, found.fetchall()))


@pytest.mark.parametrize("name", ["op5_suffix_dedup", "op6_jump_sharding", "op7_quality_cascade"])
def test_query_equals_its_sql(spark, name):
    same(spark, "/root/testdata/sf0.001", "/root/testdata/sf0.001/documents.parquet", name)


@pytest.mark.parametrize("name", ["op5_suffix_dedup", "op6_jump_sharding", "op7_quality_cascade"])
def test_query_equals_its_sql_on_odd_texts(spark, tmp_path, name):
    line = "the same words come again and again in this line of text for every reader to see now\n"
    texts = [None, "", line * 3, line * 3, "x" + line * 2, "été ß 日本語 " * 30, "### LOUD WORDS ONLY " * 40, "- a b\n" * 60, "  \t\n \x0b"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    same(spark, str(tmp_path), f"{tmp_path}/documents.parquet/*.parquet", name)
