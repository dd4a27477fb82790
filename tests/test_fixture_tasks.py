"""The derived export is written by tasks of bounded rows, whatever the input's files."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from touchpath.sources import fixtures

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark, rows, folder):
    start = datetime(2024, 1, 3)
    made = [(i, None if i % 50 == 7 else start + timedelta(seconds=40 * i), None if i % 70 == 3 else i % 9, ("view", "signup", "purchase", "error")[i % 4], 1.0, f'{{"k": {i % 100}}}')
            for i in range(rows)]
    made += made[:5]
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return spark.read.parquet(f"{folder}/events.parquet")


def test_export_tasks_hold_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "EXPORT_TASK_ROWS", 50, raising=False)
    ev = events(spark, 1200, str(tmp_path))
    assert ev.rdd.getNumPartitions() == 1
    paths = fixtures.materialise(spark, str(tmp_path))
    stored = fixtures.read_table(spark, paths, paths["events"])
    # all rows are of one day: a task's rows are a file of its folder
    per_file = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) >= 20 and max(per_file) <= 100
    want, got = (sorted(map(str, df.select(*sorted(stored.columns)).collect())) for df in (fixtures.ga4_events(ev), stored))
    assert got == want


def test_export_of_no_rows(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/events.parquet")
    paths = fixtures.materialise(spark, str(tmp_path))
    assert fixtures.read_table(spark, paths, paths["events"]).count() == 0
