"""The registered queries with SQL return the rows of their SQL."""

import duckdb
import pytest

from arbograph.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_returns_the_rows_of_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    found = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    want = sorted(map(repr, found.fetchall()))
    rows = registry.queries()[name](spark, SF)
    assert sorted(rows.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in rows.select(*columns).collect()) == want


def test_sql_and_query_agree_on_hard_rows(spark, tmp_path):
    docs = [(1, None), (2, ""), (3, "a b c d e\nA B  C d e\n\n x"), (None, "a b c d e"), (4, "a b c d e f\nx\t\n"), (4, "q"), (5, "q"),
            (6, " ".join(f"w{i}" for i in range(40))), (7, " ".join(f"w{i}" for i in range(3, 40)) + " z"), (7, "one two\nthree"), (8, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9.")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, "w0 W1 w2-w3 w4 w5 w6 w7 w8 w9 w10"), (2, "q"), (2, "One two"), (3, None), (10, "")]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    for name, sql in registry.oracle_sql().items():
        found = con.execute(sql)
        columns = [c[0] for c in found.description]
        fixed = [i for i, c in enumerate(columns) if c != "slot"]  # rows with an equal doc_id are numbered in any order
        got = registry.queries()[name](spark, str(tmp_path)).select(*columns).collect()
        assert sorted(repr([r[i] for i in fixed]) for r in got) == sorted(repr([r[i] for i in fixed]) for r in found.fetchall()), name
