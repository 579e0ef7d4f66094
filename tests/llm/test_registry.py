"""The registered queries over sf0.001, against DuckDB where SQL expresses them."""
import duckdb
import pytest

import __spark_entry__ as entry
from revlens.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert QUERIES.keys() <= entry.queries().keys()
    assert {n for n, (_, sql) in QUERIES.items() if sql} <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_sql(spark, name):
    fn, sql = QUERIES[name]
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = fn(spark, SF), con.sql(sql)
    order = sorted(want.columns)
    assert sorted(got.columns) == order
    assert sorted([tuple(r[c] for c in order) for r in got.collect()], key=str) == sorted(
        con.sql(f"select {', '.join(order)} from ({sql})").fetchall(), key=str)


COUNTS = {"op4_secrets": "documents", "op7_decontamination": "documents", "op8_quality": "documents", "op9_language": "documents",
          "op10_simhash": "documents", "op13_pii": "documents"}


@pytest.mark.parametrize("name", sorted(COUNTS))
def test_a_row_for_every_row(spark, name):
    n = duckdb.sql(f"select count(*) from '{SF}/{COUNTS[name]}.parquet'").fetchall()[0][0]
    assert QUERIES[name][0](spark, SF).count() == n
