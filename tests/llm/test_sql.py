"""Every query of this part against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from docspark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(ORACLE_SQL[name])
    columns, want = [c[0] for c in found.description], found.fetchall()
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    plain = lambda rows: sorted(tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in rows)
    key = lambda r: str(r)
    assert sorted(plain(got.select(*columns).collect()), key=key) == sorted(plain(want), key=key) and want
