"""Every registered query against its DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import digest
from touchpath.plans.queries import QUERIES as OWN

# the library's own queries (the training-data operators have tests of their own)
QUERIES = {name: E.queries()[name] for name in OWN}
ORACLES = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLES[name])
    ocols, orows = rel.columns, rel.fetchall()
    # same type family per column (64-bit integers, text, dates)
    fam = {"bigint": "int", "string": "text", "date": "date", "BIGINT": "int", "VARCHAR": "text", "DATE": "date", "BOOLEAN": "boolean"}
    st = {f.name: fam.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    dt = {c: fam.get(str(t), str(t)) for c, t in zip(ocols, rel.types)}
    assert st == dt
    hs, cs, ls = digest(cols, rows)
    ho, co, lo = digest(ocols, orows)
    assert cs == co
    assert len(rows) == len(orows)
    assert sorted(set(ls) - set(lo))[:3] == [] and hs == ho


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["session_channel_group", "sessions"]
    assert len(rows) > 0
