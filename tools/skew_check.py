"""Skew check: largest per-task input of the skew-split forms vs plain windows.

Derives a skewed variant of the fixture (a third of all events moved onto one
session key; a third of all sessions onto one user key), runs the event
numbering, the look-back and the first/last aggregate in both forms, and reads
Spark's event log (written to a scratch folder) for the largest number of
shuffle records a single task read.

usage: python tools/skew_check.py [sf_dir] > SKEW.md
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


def task_stats(log_dir: str) -> dict[str, dict]:
    stage_group, per_group = {}, {}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if not os.path.isfile(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif ev.get("Event") == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    recs = int(m.get("Total Records Read", 0))
                    g = stage_group.get(ev.get("Stage ID"))
                    if g:
                        s = per_group.setdefault(g, {"max_task_records": 0, "records": 0})
                        s["max_task_records"] = max(s["max_task_records"], recs)
                        s["records"] += recs
    return per_group


def main():
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from touchpath.operators import sessions as S
    from touchpath.operators.skew import number_within
    from touchpath.plans.chain import fixture_chain
    from touchpath.session import get_session
    from touchpath.sources import sinks

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="touchpath-skew-")
    # partition coalescing off: every hash partition is its own task, so the
    # largest task shows how the rows of the hot key were distributed
    spark = get_session("local[8]", shuffle_partitions=64,
                        extra={"spark.driver.memory": "8g", "spark.eventLog.enabled": "true",
                               "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
                               "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc = spark.sparkContext
    ch = fixture_chain(spark, sf)
    hot = F.abs(F.hash("sk_id")) % 3 == 0
    events = ch.events.withColumn("session_key", F.when(hot, F.lit("HOT")).otherwise(F.col("session_key")))
    sessions = ch.first_last.withColumn(
        "user_key", F.when(F.abs(F.hash("session_key")) % 3 == 0, F.lit("HOT")).otherwise(F.col("user_key")))
    n_events, n_sessions = events.count(), sessions.count()
    # a third of the events on one day, for the sink layout
    hot_day = ch.events.select("event_date_dt", "session_key", "sk_id", "event_timestamp").withColumn(
        "event_date_dt", F.when(F.abs(F.hash("sk_id")) % 3 == 0, F.lit("2024-01-15").cast("date"))
        .otherwise(F.col("event_date_dt")))
    # a third of the page views carry the same (matching) click id
    pv = S.traffic_params(ch.traffic_events, ch.cfg)
    names = S.gclid_name_table(ch.gclid_campaigns, ch.cfg)
    hot_gclid = names.select("gclid").orderBy("gclid").first()[0]
    pv_hot = pv.withColumn("gclid", F.when(F.abs(F.hash("sk_id")) % 3 == 0, F.lit(hot_gclid)).otherwise(F.col("gclid")))
    runs = {
        "event number, skew-split (session, hour)":
            lambda: number_within(events, "session_key", ["event_timestamp", "sk_id"], ch.cfg.numbering_bucket_us, "n"),
        "event number, plain window (session)":
            lambda: events.withColumn("n", F.row_number().over(
                Window.partitionBy("session_key").orderBy("event_timestamp", "sk_id"))),
        "look-back, as-of scan (ranges of user, start)":
            lambda: S.session_last_user_source(sessions, ch.cfg, strategy="asof"),
        "look-back, plain window (user)":
            lambda: S.session_last_user_source(sessions, ch.cfg, strategy="window"),
        "page views ⟕ campaign names, membership filter":
            lambda: S.join_gclid_names(pv, names, stored=True),
        "page views ⟕ campaign names, all shuffled":
            lambda: S.join_gclid_names(pv, names),
        "page views ⟕ campaign names, hot gclid (AQE skew split)":
            lambda: S.join_gclid_names(pv_hot, names),
        "page views ⟕ campaign names, hot gclid (AQE skew split off)":
            lambda: S.join_gclid_names(pv_hot, names),
        "sink write, hot day (rebalance, AQE split)":
            lambda: sinks._layout(hot_day, "event_date_dt", ["session_key"]),
        "sink write, hot day (plain repartition by day)":
            lambda: hot_day.repartition("event_date_dt").sortWithinPartitions("event_date_dt", "session_key"),
        "first/last source, partial aggregate (session)":
            lambda: S.session_first_last_source(
                ch.traffic.withColumn("session_key", F.when(F.abs(F.hash("sk_id")) % 3 == 0, F.lit("HOT"))
                                      .otherwise(F.col("session_key"))), ch.cfg),
    }
    times = {}
    saved = {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold")}
    for label, make in runs.items():
        sc.setJobGroup(label, label)
        for k, v in saved.items():
            if v is not None:
                spark.conf.set(k, v)
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false" if label.endswith("split off)") else "true")
        if "AQE skew" in label or "hot day" in label:
            # the skew thresholds scaled down to this data size (defaults are
            # sized for 100+ MB partitions); the broadcast of the small side is
            # switched off so the shuffled join is what is measured
            spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
            spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times[label] = time.perf_counter() - t0
    # one user with many sessions inside one look-back: the sliding frame of
    # the plain window is re-aggregated on every row, the as-of scan carries one
    # value along
    from datetime import date as _date
    from touchpath.config import RunConfig
    n = 30000
    st = "struct<source:string,medium:string,campaign:string,page_pagetype:string>"
    src = F.struct(F.lit("s").alias("source"), F.lit("m").alias("medium"),
                   F.lit(None).cast("string").alias("campaign"), F.lit(None).cast("string").alias("page_pagetype"))
    one_user = spark.range(n).select(
        F.lit(_date(2024, 1, 1)).alias("event_date_dt"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("session_key"),
        F.lit("HOT").alias("user_key"), (F.lit(1_700_000_000) + F.col("id")).alias("session_start_time"),
        F.lit(1).cast("bigint").alias("event_no"), F.lit(None).cast(st).alias("first_value_session"),
        F.when(F.col("id") % 7 == 0, src).cast(st).alias("last_non_null_value_session")).repartition(8)
    frame_times = {}
    for strategy in ("asof", "window"):
        sc.setJobGroup(f"frame-{strategy}", strategy)
        t0 = time.perf_counter()
        S.session_last_user_source(one_user, RunConfig(run_date=_date(2024, 6, 1)),
                                   strategy=strategy).write.format("noop").mode("overwrite").save()
        frame_times[strategy] = time.perf_counter() - t0
    spark.stop()
    stats = task_stats(log_dir)
    print("# Skew check\n")
    print(f"Input `{sf}` with a third of all {n_events:,} events moved onto one session key and a third of all "
          f"{n_sessions:,} sessions onto one user key (local[8], 64 shuffle partitions, AQE partition coalescing off so "
          "each hash partition is one task). `max task records` is the largest number of shuffle records one task "
          "read in the run (Spark event log); a third of the rows is "
          f"{n_events // 3:,} events or {n_sessions // 3:,} sessions.\n")
    print("| run | max task records | all shuffle records | wall (s) |")
    print("| --- | --- | --- | --- |")
    for label in runs:
        s = stats.get(label, {"max_task_records": 0, "records": 0})
        print(f"| {label} | {s['max_task_records']:,} | {s['records']:,} | {times[label]:.2f} |")
    print(f"\nOne user with {n:,} sessions within 9 hours (90-day look-back): as-of scan "
          f"{frame_times['asof']:.2f} s, plain sliding-frame window {frame_times['window']:.2f} s.")
    print("\nGenerated by `tools/skew_check.py`.")


if __name__ == "__main__":
    main()
