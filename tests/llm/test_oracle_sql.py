"""The training-data queries against their DuckDB SQL on sf0.001."""
import duckdb
import pytest
from helpers import collected

from stridex.llm import LLM_ORACLE, LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = LLM_QUERIES[name](spark, SF)
    res = con.execute(LLM_ORACLE[name])
    names = [c[0] for c in res.description]
    want = sorted((tuple(r[names.index(c)] for c in df.columns) for r in res.fetchall()), key=repr)
    assert sorted(names) == sorted(df.columns) and collected(df) == want
