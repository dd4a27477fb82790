"""What one task holds does not grow with the input: shuffles, ranges and model files by rows."""

import re

import pytest
from pyspark.sql import functions as F

from tests.test_fixture_tasks import events
from touchpath import session
from touchpath.operators.asof import last_before
from touchpath.plans import chain, queries


@pytest.fixture
def sized(spark):
    """The session, with the number of its shuffles' first partitions as it was."""
    before = spark.conf.get(session.INITIAL_PARTITIONS, None)
    yield spark
    if before is None:
        spark.conf.unset(session.INITIAL_PARTITIONS)
    else:
        spark.conf.set(session.INITIAL_PARTITIONS, before)


def test_shuffles_begin_with_bounded_rows(sized, tmp_path, monkeypatch):
    events(sized, 1000, str(tmp_path))
    monkeypatch.setattr(session, "SHUFFLE_ROWS", 50)
    daily = queries.run(sized, "daily_sessions", str(tmp_path))
    assert sized.conf.get("spark.sql.shuffle.partitions") == "8" and session.shuffle_width(sized) == 21
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"(?:hash|range)partitioning\(.*?, (\d+)\)", plan)) == {"21"}
    # the number is only raised: an earlier, larger plan may not have run yet
    session.size_shuffles(sized, 60)
    assert session.shuffle_width(sized) == 21


def test_ranges_follow_the_shuffles(sized):
    sized.conf.set(session.INITIAL_PARTITIONS, "19")
    rows = sized.range(400).select((F.col("id") % 5).alias("k"), "id", (F.col("id") * 2).alias("v"))
    found = last_before(rows, "k", "id", "id", "v", "before", 1000)
    assert re.search(r"rangepartitioning\(.*, 19\)", found._jdf.queryExecution().executedPlan().toString())
    assert {r.id: r.before for r in found.collect()} == {i: (i - 5) * 2 if i >= 5 else None for i in range(400)}


def test_model_files_hold_bounded_rows(spark, tmp_path, monkeypatch):
    events(spark, 1000, str(tmp_path))
    monkeypatch.setattr(chain, "MODEL_FILE_ROWS", 60, raising=False)
    ch = chain.fixture_chain(spark, str(tmp_path))
    per_file = [r["count"] for r in ch.traffic_events.groupBy(F.input_file_name()).count().collect()]
    assert max(per_file) <= 60 and sum(per_file) == ch.events.count() > 900
