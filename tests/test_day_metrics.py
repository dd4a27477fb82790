"""Counts observed while models are written: the tests need no second read of them, and equal those that read the tables."""

from datetime import date

import pytest

from tests.conftest import SF_SMALL
from touchpath.operators.quality import model_suite
from touchpath.plans.chain import fixture_chain
from touchpath.session import scratch_path
from touchpath.streaming.day_metrics import DayMetrics
from touchpath.streaming.incremental import IncrementalRunner

MODELS = ("silent_sessions", "traffic_events", "session_channel_groups", "session_starts")


def rows(df):
    return sorted(map(tuple, df.select("check", "n_failed", "status").collect()))


@pytest.fixture(scope="module")
def daily(spark):
    ch = fixture_chain(spark, SF_SMALL, variant="urlparam")
    r = IncrementalRunner(spark, scratch_path(spark, "t-metrics"), ch.raw_events, {}, {}, variant="urlparam")
    seen = {}
    for day in (28, 29, 31):
        r.run(date(2024, 1, day))
        seen[day] = (rows(r.metrics.suite(r.table, date(2024, 1, day))), rows(model_suite(*[r.table(m) for m in MODELS], date(2024, 1, day))))
    return r, seen


def test_observed_counts_equal_a_full_read_after_every_run(daily):
    _, seen = daily
    for day, (observed, read) in seen.items():
        assert observed == read, day
    assert len(seen[31][0]) == 9


def test_metrics_of_each_day_equal_a_rebuild(spark, daily):
    r, _ = daily
    again = DayMetrics(spark, scratch_path(spark, "t-metrics-again"))
    for model in DayMetrics.MODELS:
        again.rebuild(model, r.table(model))
        assert sorted(map(tuple, r.metrics.table(model).collect()), key=str) == sorted(map(tuple, again.table(model).collect()), key=str), model


def test_the_suite_reads_no_model_but_for_uniqueness(daily):
    r, _ = daily
    plan = r.metrics.suite(r.table, date(2024, 1, 31))._jdf.queryExecution().executedPlan().toString()
    for model in ("silent_sessions", "traffic_events"):
        assert f"{r.root.removeprefix('file:')}/{model}" not in plan
    assert plan.count("dq_metrics") >= 3


def test_emptied_days(spark):
    from pyspark.sql import functions as F

    metrics = DayMetrics(spark, scratch_path(spark, "t-metrics-empty"))
    assert metrics.observation("session_starts", [date(2024, 1, 1)]) is None  # nothing is stored yet
    df = spark.createDataFrame([(date(2024, 1, 1), "a"), (date(2024, 1, 2), None), (date(2024, 1, 2), "b")], "event_date_dt date, sk_id string")
    metrics.rebuild("session_starts", df)
    for emptied, left in ((False, {(date(2024, 1, 1), "rows", 1), (date(2024, 1, 2), "rows", 2), (date(2024, 1, 2), "no_key", 1)}), (True, {(date(2024, 1, 1), "rows", 1)})):
        obs, cols = metrics.observation("session_starts", [date(2024, 1, 2)])
        df.where(F.lit(False)).observe(obs, *cols).write.format("noop").mode("overwrite").save()
        metrics.record("session_starts", [date(2024, 1, 2)], obs, emptied)
        assert set(map(tuple, metrics.table("session_starts").collect())) == left


def test_counts_that_end_before_their_model_are_dropped(spark, daily):
    from pyspark.sql import functions as F

    r, _ = daily
    m = DayMetrics(spark, scratch_path(spark, "t-metrics-behind"))
    r.table("session_starts").write.partitionBy("event_date_dt").parquet(f"{m.root}/session_starts")
    m.rebuild("session_starts", r.table("session_starts").where(F.col("event_date_dt") < F.lit(date(2024, 1, 30))))
    assert m.observation("session_starts", [date(2024, 1, 30)]) is None and m.observation("session_starts", [date(2024, 1, 30)]) is None
    m.rebuild("session_starts", r.table("session_starts"))
    assert m.observation("session_starts", [date(2024, 1, 30)]) is not None


def test_a_long_log_is_written_anew(spark, monkeypatch):
    from touchpath.sources import sinks
    from touchpath.streaming import day_metrics

    monkeypatch.setattr(day_metrics, "COMPACT", 3)
    metrics = DayMetrics(spark, scratch_path(spark, "t-metrics-log"))
    df = spark.createDataFrame([(date(2024, 1, d), f"k{d}") for d in range(1, 9)], "event_date_dt date, sk_id string")
    metrics.rebuild("session_starts", df.where("false"))
    for d in range(1, 9):
        obs, cols = metrics.observation("session_starts", [date(2024, 1, d)])
        df.observe(obs, *cols).write.format("noop").mode("overwrite").save()
        metrics.record("session_starts", [date(2024, 1, d)], obs, False)
        assert len(sinks.files(spark, metrics.path("session_starts"))) <= 3
    assert set(map(tuple, metrics.table("session_starts").collect())) == {(date(2024, 1, d), "rows", 1) for d in range(1, 9)}
