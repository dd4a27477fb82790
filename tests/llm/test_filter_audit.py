import itertools
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm.conftest import SCHEMA, corpus
from touchpath.llm import filter_audit
from touchpath.llm.queries import ORACLES, QUERIES

LABELS = "doc_id long, quality int, toxic int"


def labels_for(rows, seed=2):
    rng = random.Random(seed)
    out = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows if rng.random() < 0.7]
    return [*out, *rng.sample(out, 5), (None, 1, 1), (10**9, 1, 1)]


def failing(rows):
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    out = []
    for doc_id, text, _, source, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": doc_id is not None and t in first and doc_id > first[t]}
        out.append((doc_id, source or "", {f for f, v in fails.items() if v}))
    return out


def replayed(rows, labels):
    """Every order applied to the documents one filter after another."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, x in labels if d is not None and x == 1}
    by = {}
    for r in failing(rows):
        by.setdefault(r[1], []).append(r)
    out = {}
    for part, docs in by.items():
        total = dict.fromkeys("ABCDE", 0)
        here = []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[2]]
                left = [r for r in left if f not in r[2]]
                total[f] += len(gone)
                here.append(("".join(order), step, f, len(left), len(gone), sum(f in r[2] for r in docs) - len(gone),
                             sum(r[2] == {f} for r in docs), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)))
        for o, step, f, *counts in here:
            out[part, o, step] = (*counts, total[f])
    return out


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def rows_of(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in df.collect()}


SHOUTS = [(2000, "ABC $ " * 60, "en", "s1", 0), (2001, "ABC $ " * 60, "en", None, 0), (2002, "x" * 200_000 + " #", "en", "", 0), (2003, "Ab é" * 30, None, "s2", 0)]


def test_audit_equals_replayed_orders(spark):
    rows = corpus(3, 50) + SHOUTS
    labels = labels_for(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumnsRenamed({"source": "part"})
    docs = docs.withColumns({c: F.lit("x") for c in ("digest", "fails", "mask", "good", "n", "_salt", "seen")})
    out = filter_audit.audit_documents(docs, spark.createDataFrame(labels, LABELS).withColumn("digest", F.lit(1)))
    got = rows_of(out)
    assert got == replayed(rows, labels)
    assert len(got) == 600 * len({r[3] or "" for r in rows})


def test_query_equals_its_sql_on_odd_rows(spark, table):
    import duckdb

    rows = corpus(4, 40) + SHOUTS
    folder = table(rows)
    spark.createDataFrame(labels_for(rows), LABELS).write.parquet(f"{folder}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    cols = ["part", "filter_order", "step", *COLUMNS]
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLES['op11_filter_audit']})").fetchall()
    got = QUERIES["op11_filter_audit"](spark, folder).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_empty_tables(spark, table):
    folder = table([])
    spark.createDataFrame([], LABELS).write.parquet(f"{folder}/labels.parquet")
    assert QUERIES["op11_filter_audit"](spark, folder).collect() == []


def test_documents_without_labels_or_ids(spark):
    rows = [(None, "same text", None, "a", 0)] * 3 + [(None, None, None, None, 0), (5, "same text", None, "a", 0), (5, "same text", None, "a", 0), (6, "same text", None, "b", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("source", "part")
    got = rows_of(filter_audit.audit_documents(docs, spark.createDataFrame([], LABELS)))
    assert got == replayed(rows, [])
    assert got["b", "EABCD", 1][1] == 1 and got["a", "EABCD", 1][1] == 0


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_potential_gives_shapley_values(spark, k):
    rng = random.Random(k)
    counts = [("p", m, rng.randrange(9), rng.randrange(3), rng.randrange(3)) for m in range(1 << k)]
    out = filter_audit.audit(spark.createDataFrame(counts, "part string, mask int, n long, good long, toxic long"), "VWXYZ"[:k]).collect()
    by = {}
    for r in out:
        by.setdefault(r["filter_order"][r["step"] - 1], []).append(r)
    for rows in by.values():
        assert {r["shapley"] for r in rows} == {sum(r["removed"] for r in rows)}
    first = [r for r in out if r["step"] == k]
    assert {r["kept"] for r in first} == {counts[0][2]}
