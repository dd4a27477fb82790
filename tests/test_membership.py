"""The membership filter: no member is lost, its rows are bounded, few others pass."""

import random

import pytest
from pyspark.sql import functions as F

from touchpath.operators import membership as M


def frames(spark, seed=1):
    rng = random.Random(seed)
    members = [(rng.choice([None, f"k{rng.randrange(3000)}"]), rng.randrange(3)) for _ in range(900)]
    rows = [(i, rng.choice([None, f"k{rng.randrange(3000)}"]), rng.randrange(4)) for i in range(5000)]
    return spark.createDataFrame(members, "k string, n int"), spark.createDataFrame(rows, "id long, k string, n int"), members, rows


@pytest.mark.parametrize("bits", [64, 1 << 10, 1 << 26])
def test_members_pass_whatever_the_size(spark, monkeypatch, bits):
    monkeypatch.setattr(M, "BITS", bits)
    members, rows, known, every = frames(spark)
    known = {m for m in known if m[0] is not None}
    words = M.key_filter(members, ["k", "n"])
    passed = {r.id for r in M.possible_members(rows, ["k", "n"], words).collect()}
    assert {i for i, k, n in every if (k, n) in known} <= passed
    assert not passed & {i for i, k, _ in every if k is None}
    assert words.count() <= bits // 64
    others = [i for i, k, n in every if k is not None and (k, n) not in known]
    if bits == 1 << 26:
        assert sum(i in passed for i in others) < 0.01 * len(others)


def test_marks_keep_every_row(spark):
    members, rows, known, every = frames(spark, 2)
    out = M.with_membership(rows, ["k"], M.key_filter(members, ["k"]), "may").collect()
    names = {m[0] for m in known if m[0] is not None}
    assert len(out) == len(every) and {r.id for r in out if r.may} >= {i for i, k, _ in every if k in names}
    none = M.with_membership(rows, ["k"], M.key_filter(members.where("false"), ["k"]), "may")
    assert none.where("may").isEmpty() and none.count() == len(every)
    assert M.possible_members(rows.where("false"), ["k"], M.key_filter(members, ["k"])).isEmpty()


def test_hashes_of_any_sign(spark):
    ids = spark.range(-500, 500).select(F.col("id").alias("k"))
    assert M.possible_members(ids, ["k"], M.key_filter(ids.where("k % 7 = 0"), ["k"])).where("k % 7 = 0").count() == 143
