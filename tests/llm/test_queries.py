"""The registered queries: names, and the URL rules' SQL on DuckDB."""

import duckdb

import __spark_entry__ as entry
from quarry.llm import queries


def test_one_query_for_each_operator():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14)) and set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


def test_url_rules_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({queries.ORACLE['op5_url_filter']})").fetchall()
    assert sorted(map(tuple, queries.QUERIES["op5_url_filter"](spark, sf).collect())) == sorted(want)
