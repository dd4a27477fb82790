"""Labels computed once per distinct tuple: the same as row by row."""

import random

import pytest
from pyspark.sql import functions as F

from touchpath.functions.channels import custom_channel_group
from touchpath.operators import dictionary
from touchpath.operators.dictionary import Dictionary
from touchpath.sources import sinks

COLS = ["source", "medium", "campaign", "page"]


def rows(spark, n=4000):
    rng = random.Random(3)
    pick = lambda *v: rng.choice(v)
    data = [(i, None, None, None, None, {"a": i}) if i % 3 else
            (i, pick("google", "bing", "criteo", "facebook", None, ""), pick("cpc", "organic", "referral", None), pick("x_2_de", "x_5_at", None, ""),
             pick("start", "magazine", None), None) for i in range(n)]
    return spark.createDataFrame(data, "n int, source string, medium string, campaign string, page string, m map<string,int>")


@pytest.mark.parametrize("most", [dictionary.BROADCAST_BYTES, 0])
def test_labels_equal_the_rules_row_by_row(spark, monkeypatch, most):
    """A third of distinct tuples, the rest one tuple of NULLs; broadcast, and joined
    by a shuffle with the hot tuple dealt to places."""
    monkeypatch.setattr(dictionary, "BROADCAST_BYTES", most)
    df = rows(spark).repartition(4)
    want = df.select("n", custom_channel_group(*[F.col(c) for c in COLS]).alias("g"))
    with Dictionary(df, COLS, custom_channel_group) as d:
        assert d.small == (most > 0) and d.tuples < 300
        got = d.apply(df, "g")
        assert got.columns == [*df.columns, "g"] and got.count() == 4000
        got = got.select("n", "g")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "RLIKE" not in plan                                   # no pattern is tried on a row
        if most:
            assert plan.count("Exchange hashpartitioning") == 0      # and no row is shuffled
        else:
            sizes = [r["count"] for r in df.select(F.pmod(F.xxhash64("n", *COLS), F.lit(dictionary.SALTS)).alias("p")).groupBy("p").count().collect()]
            assert max(sizes) < 4000 / 8
    assert not sinks.exists(spark, d.path)


def test_unknown_tuples_and_empty_tables(spark):
    df = rows(spark, 30)
    with Dictionary(df.where("n < 0"), COLS, custom_channel_group) as d:
        assert d.tuples == 0 and d.small
        assert d.apply(df, "g").where("g IS NOT NULL").count() == 0
    with Dictionary(df, COLS, custom_channel_group) as d:
        assert d.apply(df.where("n < 0"), "g").count() == 0
        assert d.apply(df.withColumn("g", F.lit(1)), "g").columns == [*df.columns, "g"]   # replaces a column of that name
