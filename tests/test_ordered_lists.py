"""Ordered string aggregates need no join: neither the operator nor the query of three."""

from tests.test_fixture_tasks import events
from touchpath.operators.sessions import ordered_string_agg
from touchpath.plans import queries


def test_ordered_lists_hold_no_join(spark, tmp_path):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("a", None, "z"), ("b", 1, None), (None, 1, "n")], "k string, at long, text string")
    out = ordered_string_agg(df, ["k"], "text", ["at"], "joined", "-", 1)
    assert {r.k: r.joined for r in out.collect()} == {"a": "z-x-y", "b": None, None: "n"}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    events(spark, 300, str(tmp_path))
    plan = queries.run(spark, "ordered_string_agg", str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
