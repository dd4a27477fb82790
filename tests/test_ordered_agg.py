"""Ordered string aggregate: any text, ties, NULLs, buckets, a hot key."""

import random

import pytest

from touchpath.operators.sessions import ordered_string_agg


def brute(rows, sep):
    out = {}
    for key, at, text in rows:
        out.setdefault(key, []).append((at is not None, at or 0, text))
    return {k: sep.join(t for *_, t in sorted(r for r in v if r[2] is not None)) if any(r[2] is not None for r in v) else None for k, v in out.items()}


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_against_brute_force(spark, width):
    rng = random.Random(width)
    rows = []
    for i in range(1500):
        key = rng.choice(["hot"] * 5 + ["a", "b", "", None])
        at = None if rng.random() < 0.05 else rng.randrange(-40, 200)
        rows.append((key, at, rng.choice(["x", "page_view", "it's", "", "a, b", None])))
    rows += [("none", 3, None), ("none", 4, None)]
    df = spark.createDataFrame(rows, "k string, at long, text string")
    for sep in (",", " > "):
        out = ordered_string_agg(df, ["k"], "text", ["at", "text"], "joined", sep, width).collect()
        assert {r.k: r.joined for r in out} == brute(rows, sep) and len(out) == len({r[0] for r in rows})


def test_empty(spark):
    df = spark.createDataFrame([], "k string, at long, text string")
    assert ordered_string_agg(df, ["k"], "text", ["at"], "joined").collect() == []


def test_lists_are_built_per_bucket(spark):
    df = spark.createDataFrame([("k", i, str(i)) for i in range(10)], "k string, at long, text string")
    out = ordered_string_agg(df, ["k"], "text", ["at"], "joined", width=3)
    assert out.first().joined == "0,1,2,3,4,5,6,7,8,9"
    assert "__bucket" in out._jdf.queryExecution().optimizedPlan().toString()
