"""Skew-split event numbering equals a plain row_number, NULL keys included."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchpath.operators.skew import left_join_known, left_join_nonnull, number_within


@pytest.mark.parametrize("hot_rows", [5, 60, 1_000_000])
def test_number_within_matches_row_number(spark, hot_rows):
    rnd = random.Random(3)
    rows = []
    for i in range(5000):
        key = None if i % 7 == 0 else ("hot" if i % 3 == 0 else f"k{rnd.randint(0, 50)}")
        ts = None if i % 251 == 0 else rnd.randint(-10_000, 10_000_000)
        rows.append((key, ts, f"id{i}"))
    df = spark.createDataFrame(rows, "k string, ts long, id string")
    got = number_within(df, "k", ["ts", "id"], 100_000, "n", hot_rows)
    ref = df.withColumn("r", F.row_number().over(
        Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_first(), "id")))
    j = got.join(ref, "id")
    assert got.count() == 5000
    assert j.where(F.col("n") != F.col("r")).count() == 0


def test_left_join_nonnull_keeps_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, g string")
    right = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "g string, name string")
    out = left_join_nonnull(left, right, ["g"], ["name"])
    assert out.columns == ["g", "id", "name"]
    got = sorted((r.id, r.name) for r in out.collect())
    assert got == [(1, "x"), (1, "y"), (2, None), (3, None)]


def test_base_event_numbering_strategies_agree(spark):
    from tests.conftest import SF_SMALL
    from touchpath.plans.chain import fixture_chain
    a = fixture_chain(spark, SF_SMALL).base.select("sk_id", "session_key", "session_event_number")
    b = fixture_chain(spark, SF_SMALL, numbering="window").base.select("sk_id", "session_key", "session_event_number")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_null_key_is_split_inside_its_bucket(spark):
    """A third of one hour on the NULL key: no window group holds more than a
    few of its rows."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("k"), (F.col("id") * 60).alias("ts"), "id")
    out = number_within(df, "k", ["ts", "id"], 3_600_000, "n")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__s" in plan
    assert out.where("k IS NULL").agg(F.max("n")).first()[0] == 20_000


def test_left_join_reads_its_left_side_once_and_spreads_nulls(spark):
    left = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.col("id") % 50).alias("g"))
    right = spark.range(0, 50, 2).select(F.col("id").alias("g"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    out = left_join_nonnull(left, right, ["g"], ["name"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and len(re.findall(r"hashpartitioning\(g#\d+L?, __salt", plan)) == 2
    assert out.count() == 4000 and out.where("name IS NOT NULL").count() == left.where("g % 2 = 0").count()


def test_left_join_known_equals_a_left_join(spark):
    rnd = random.Random(12)
    left = spark.createDataFrame([(i, rnd.choice([None, None, f"g{rnd.randrange(2000)}"]), rnd.random()) for i in range(3000)], "id long, g string, x double")
    right = spark.createDataFrame([(f"g{rnd.randrange(4000)}", f"n{i}") for i in range(60)] + [(None, "never"), ("g1", "a"), ("g1", "b")], "g string, name string")
    for names in (right, right.where("false")):
        got = left_join_known(left, names, ["g"], ["name"])
        want = left.join(names, "g", "left").select("g", "id", "x", "name")
        assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_rows_without_a_partner_are_not_shuffled(spark):
    """The exchange of the page views carries the matched share, not the table."""
    from pyspark.sql import Row

    n = 20_000
    left = spark.range(n).select("id", F.when(F.col("id") % 4 == 0, F.concat(F.lit("g"), F.col("id").cast("string"))).alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    right = spark.createDataFrame([Row(g=f"g{i}", name=f"n{i}") for i in range(0, 2000, 4)])
    out = left_join_known(left, right, ["g"], ["name"])
    assert out.where("name IS NOT NULL").count() == 500 and out.count() == n
    out.collect()
    plan = out._jdf.queryExecution().executedPlan()
    written, todo = [], [plan.finalPhysicalPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    assert written and max(written) <= 520
