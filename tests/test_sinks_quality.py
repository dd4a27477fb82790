"""Sinks (full, dynamic, static overwrite, schema guard, high-water mark) and DQ checks."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from touchpath.operators import quality as Q
from touchpath.session import scratch_path
from touchpath.sources import sinks

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def _df(spark, rows):
    return spark.createDataFrame(rows, "event_date_dt date, k string, v long")


def _read(spark, path):
    return sorted((r.event_date_dt, r.k, r.v) for r in spark.read.parquet(path).collect())


def test_dynamic_and_static_overwrite(spark):
    path = scratch_path(spark, "t-sinks")
    sinks.write_full(_df(spark, [(D1, "a", 1), (D2, "b", 2), (D3, "c", 3)]), path)
    sinks.write_dynamic(_df(spark, [(D2, "b2", 20)]), path)
    assert _read(spark, path) == [(D1, "a", 1), (D2, "b2", 20), (D3, "c", 3)]
    # static list D2, D3: D3 has no new rows and is emptied, D2 replaced, D1 untouched
    sinks.write_static(spark, _df(spark, [(D2, "b3", 30)]), path, "event_date_dt", [D2, D3])
    assert _read(spark, path) == [(D1, "a", 1), (D2, "b3", 30)]
    # an empty reload empties every listed partition
    sinks.write_static(spark, _df(spark, []), path, "event_date_dt", [D1])
    assert _read(spark, path) == [(D2, "b3", 30)]
    # rows outside the list are refused before anything is touched
    with pytest.raises(sinks.OutsidePartitionsError):
        sinks.write_static(spark, _df(spark, [(D1, "x", 9), (D3, "y", 8)]), path, "event_date_dt", [D1])
    assert _read(spark, path) == [(D2, "b3", 30)]
    sinks.write_static(spark, _df(spark, [(D1, "x", 9), (D3, "y", 8)]), path, "event_date_dt", [D1, D3])
    assert _read(spark, path) == [(D1, "x", 9), (D2, "b3", 30), (D3, "y", 8)]
    # no staging folder is left beside the table
    assert [n for n in os.listdir(os.path.dirname(path)) if n.startswith(os.path.basename(path))] == [os.path.basename(path)]
    assert sinks.high_water_mark(spark, path) == D3
    assert sinks.high_water_mark(spark, path + "-missing") is None


def test_schema_guard(spark):
    path = scratch_path(spark, "t-guard")
    sinks.write_full(_df(spark, [(D1, "a", 1)]), path, guard_schema=True)
    sinks.write_dynamic(_df(spark, [(D1, "b", 2)]), path, guard_schema=True)
    bad = spark.createDataFrame([(D1, "a", "x")], "event_date_dt date, k string, v string")
    with pytest.raises(sinks.SchemaChangeError):
        sinks.write_dynamic(bad, path, guard_schema=True)


def test_quality_checks_good_and_broken(spark):
    good = spark.createDataFrame([(D1, "s1", "k1", "generic_paid_search"), (D2, "s2", "k2", "brand_paid_search")],
                                 "event_date_dt date, sk_id string, session_key string, session_gadscampaign string")
    bad = spark.createDataFrame([(D1, "s1", "k1", "generic_paid_search"), (D1, "s1", None, "oops"),
                                 (D3, "s3", "k1", "oops")],
                                "event_date_dt date, sk_id string, session_key string, session_gadscampaign string")
    def run(df):
        out = (Q.day_coverage(df, "event_date_dt", D1, date(2024, 1, 4))
               .unionByName(Q.not_null(df, "session_key"))
               .unionByName(Q.unique(df, "sk_id"))
               .unionByName(Q.in_set(df, "session_gadscampaign", ["generic_paid_search", "brand_paid_search"],
                                     F.col("session_gadscampaign").isNotNull(), severity="warn", warn_if=1))
               .unionByName(Q.unique_proportion(df, "session_key", 1, 1, severity="warn")))
        return {r.check: (r.n_failed, r.status) for r in out.collect()}
    g = run(good)
    assert g == {"day_coverage": (1, "warn"), "not_null:session_key": (0, "pass"), "unique:sk_id": (0, "pass"),
                 "in_set:session_gadscampaign": (0, "pass"), "unique_proportion:session_key": (0, "pass")}
    b = run(bad)
    assert b == {"day_coverage": (1, "warn"), "not_null:session_key": (1, "fail"), "unique:sk_id": (1, "fail"),
                 "in_set:session_gadscampaign": (2, "warn"), "unique_proportion:session_key": (1, "warn")}


def test_dynamic_overwrite_reading_its_own_target(spark):
    path = scratch_path(spark, "t-self")
    sinks.write_full(_df(spark, [(D1, "a", 1), (D2, "b", 2)]), path)
    own = spark.read.parquet(path).where(F.col("event_date_dt") == F.lit(D2)).withColumn("v", F.col("v") * 10)
    sinks.write_dynamic(own, path, stage=True)
    assert _read(spark, path) == [(D1, "a", 1), (D2, "b", 20)]


def test_failed_rebuild_keeps_the_old_table_and_leaves_no_folder(spark):
    path = scratch_path(spark, "t-atomic")
    sinks.write_full(_df(spark, [(D1, "a", 1)]), path)
    broken = _df(spark, [(D1, "b", 0)]).withColumn("v", F.expr("cast(1 / v as bigint)"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.write_full(broken, path)
    assert _read(spark, path) == [(D1, "a", 1)]
    sinks.write_full(_df(spark, [(D2, "c", 3)]), path)
    assert _read(spark, path) == [(D2, "c", 3)]
    assert [n for n in os.listdir(os.path.dirname(path)) if n.startswith(os.path.basename(path))] == [os.path.basename(path)]


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from touchpath.session import checkpoint_root
    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master, ok in (("spark://host:7077", False), ("local-cluster[2,1,1024]", False), ("yarn", False)):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_root(SimpleNamespace(conf=conf, sparkContext=sc))
    made = []
    sc = SimpleNamespace(master="local[2]", getCheckpointDir=lambda: None, setCheckpointDir=made.append)
    assert made == [] and checkpoint_root(SimpleNamespace(conf=conf, sparkContext=sc)) == made[0]
