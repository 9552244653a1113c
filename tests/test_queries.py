"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_all_queries_match_oracle(spark):
    import duckdb

    import __spark_entry__ as E
    from tools.check_oracle import TABLES, rows_of

    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sqls = E.oracle_sql()
    failures = []
    for name, q in E.queries().items():
        df = q(spark, SF)
        rows = [tuple(r) for r in df.collect()]
        if name not in sqls:
            continue
        res = con.execute(sqls[name])
        cols = [c[0] for c in res.description]
        if sorted(df.columns) != sorted(cols) or rows_of(df.columns, rows) != rows_of(cols, res.fetchall()):
            failures.append(name)
    assert failures == []
