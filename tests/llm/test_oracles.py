"""Queries that SQL can express, against their SQL on the given table."""

import duckdb
import pytest

from touchpath.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS FROM '{FOLDER}/{t}.parquet'")
    rel = con.sql(ORACLES[name])
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}
    assert {f.name: kinds[f.dataType.simpleString()] for f in df.schema.fields} == dict(zip(rel.columns, map(str, rel.types)))
    want = sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall())
    assert sorted(tuple(r) for r in df.select(*cols).collect()) == want
