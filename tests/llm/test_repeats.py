"""The part that passage and byte dedup share: large groups, repeated rows, scopes."""

import os
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, corpus
from touchpath.llm import common, passage_dedup, repeats, suffix_dedup


@pytest.mark.parametrize("module, run", [(suffix_dedup, suffix_dedup.drop_repeated_bytes), (passage_dedup, passage_dedup.drop_repeated_passages)])
def test_groups_too_large_for_one_task_give_the_same(spark, monkeypatch, module, run):
    """No group is hot, all of two rows or more are counted apart: the result stays."""
    d = spark.createDataFrame(corpus(), SCHEMA).repartition(3)
    want = sorted(map(repr, run(d).collect()))
    seen = []
    real, hot = repeats._warm, repeats._hot
    monkeypatch.setattr(repeats, "_warm", lambda *a: seen.append(real(*a)) or seen[-1])
    monkeypatch.setattr(repeats, "_hot", lambda groups, key, total, value=None: hot(groups, key, 10**9, value))
    assert sorted(map(repr, run(d, replace(module.method(), beside=1)).collect())) == want
    assert len(seen) == 2 and all(seen)
    large, rest, groups = seen[1]
    assert large.count() > 0 and not large.join(rest, ["key", "content"]).count()
    assert {tuple(r) for r in large.select("key", "content").collect()} <= {tuple(r) for r in groups.select("key", "content").collect()}


def test_ranges_do_not_grow_with_repeated_rows(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(2500))
    most = {}
    for copies in (2, 150):
        rows = repeats.keyed(spark.createDataFrame([(None, text)] * copies, "doc_id long, text string").repartition(3))
        (r,) = repeats.repeated_ranges(rows, suffix_dedup.method()).select(F.size("ranges").alias("n")).collect()
        most[copies] = r["n"]
    assert most[150] <= most[2] * 3


def test_nested_scopes_delete_their_own_tables(spark):
    """Also when both are empty, and so equal as lists, at the end of the inner one."""
    with common.scratch(spark):
        with common.scratch(spark):
            pass
        _ = common.stash(spark.range(3), "t-scope")
        (path,) = common._SCOPES[-1]
        assert os.path.isdir(path)
    assert not os.path.isdir(path) and not common._SCOPES
