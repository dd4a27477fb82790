"""Plan shape: pruning reaches the scan, no Python in the plans, aggregate-based first/last."""

import re
from datetime import date

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from touchpath.config import RunConfig
from touchpath.operators.base_events import keyed_events
from touchpath.operators.sessions import TRAFFIC_INPUT
from touchpath.plans import queries as Q
from touchpath.plans.chain import fixture_chain
from touchpath.session import scratch_path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_filters_reach_the_scan(spark):
    ch = fixture_chain(spark, SF_SMALL, cfg=RunConfig(run_date=date(2024, 1, 31), mode="incremental"))
    pf = re.findall(r"PartitionFilters: \[([^\]]*)\]", _plan(keyed_events(ch.raw_events, ch.cfg)))
    assert pf and all("shard_date" in f and "IN (2024-01-30,2024-01-29)" in f for f in pf)
    pf = re.findall(r"PartitionFilters: \[([^\]]*)\]", _plan(ch.clicks))
    assert len(pf) == 5 and all("_partition_date" in f for f in pf)


def test_first_last_is_an_aggregate_not_a_window(spark):
    ch = fixture_chain(spark, SF_SMALL)
    traffic = spark.createDataFrame(ch.traffic.limit(0).rdd, ch.traffic.schema)  # plan of M5 alone
    from touchpath.operators.sessions import session_first_last_source
    p = _plan(session_first_last_source(traffic, ch.cfg))
    assert "Window" not in p and "Aggregate" in p


def test_no_python_udf_in_any_query(spark):
    for name in ("session_channel_groups", "daily_sessions", "gclid_campaigns", "base_events", "user_last_source"):
        p = _plan(Q.run(spark, name, SF_SMALL))
        assert "EvalPython" not in p and "PythonUDF" not in p and "FlatMapGroupsInPandas" not in p, name


def test_click_id_join_reads_its_page_views_once(spark):
    ch = fixture_chain(spark, SF_SMALL)
    p = ch.adjusted._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Join LeftOuter, ((gclid") == 1 and "Union" not in p.split("Join LeftOuter, ((gclid")[0]


def _scans(df):
    """Scans of the raw export and of all tables in the plan that ran."""
    df.collect()
    plan = _plan(df)
    assert "AdaptiveSparkPlan" not in plan or "isFinalPlan=true" in plan
    final = plan.split("== Initial Plan ==")[0]
    return len(re.findall(r"FileScan parquet .*ga4_events", final)), len(re.findall(r"FileScan parquet", final))


def test_stored_boundaries_cost_one_scan_and_no_shuffle(spark):
    """What two models read is stored as it comes from one scan of the export (no
    exchange, no sort); models with one reader are not stored."""
    stored = {"base": 0, "adjusted": 0, "silent_sessions": 0, "traffic": 1, "channel_groups": 2, "daily": 2}
    for attr, n in stored.items():
        ch = fixture_chain(spark, SF_SMALL)
        scans, _ = _scans(getattr(ch, attr))
        assert len(ch._stored) == n, attr
        # the numbering reads the export for counts and rows, the session starts once
        assert scans == {"base": 2, "adjusted": 1, "silent_sessions": 1, "daily": 1}.get(attr, 0), attr
        ch.close()
        assert ch._stored == []
    lazy = fixture_chain(spark, SF_SMALL, durable=())
    copied = _plan(lazy.events.select(*TRAFFIC_INPUT))
    assert "Exchange" not in copied and "Sort" not in copied and copied.count("FileScan parquet") == 1


def test_the_url_parameter_variant_does_not_shuffle(spark):
    ch = fixture_chain(spark, SF_SMALL, variant="urlparam")
    assert "Exchange" not in _plan(ch.adjusted) and ch._stored == []


def test_a_chain_without_boundaries_runs_no_job(spark):
    ch = fixture_chain(spark, SF_SMALL, durable=())
    sc = spark.sparkContext
    sc.setJobGroup("t-no-job", "t-no-job")
    for attr in ("base", "traffic", "first_last", "channel_groups", "session_starts", "daily"):
        getattr(ch, attr)._jdf.queryExecution().executedPlan()
    assert list(sc.statusTracker().getJobIdsForGroup("t-no-job")) == []
    sc.setJobGroup("", "")


def test_data_tests_read_each_input_once(spark):
    from touchpath.operators.quality import model_suite

    ch = fixture_chain(spark, SF_SMALL)
    tables = []
    for i, df in enumerate((ch.silent_sessions, ch.traffic, ch.channel_groups, ch.session_starts)):
        path = scratch_path(spark, f"t-suite-{i}")
        df.write.parquet(path)
        tables.append(spark.read.parquet(path))
    suite = model_suite(*tables, date(2024, 1, 31))
    assert suite.count() == 9
    assert _scans(suite)[1] == 4


def test_downstream_models_skip_the_event_number(spark):
    ch = fixture_chain(spark, SF_SMALL)
    for df in (ch.silent_sessions, ch.adjusted, ch.session_starts):
        p = df._jdf.queryExecution().optimizedPlan().toString()
        assert "__k_null" not in p


def test_no_unbounded_window_groups(spark):
    """Windows over events or sessions never partition by a bare session or
    user key (a hot key would be one task): they use (key, time bucket) or
    (account, campaign, day).  Only the per-bucket summary tables, whose rows
    per key are bounded by the number of buckets, are windowed by key."""
    for name in ("base_events", "session_channel_groups", "daily_sessions", "user_last_source", "gclid_campaigns"):
        p = _plan(Q.run(spark, name, SF_SMALL))
        specs = [re.sub(r"#\d+L?", "", m) for m in re.findall(r"windowspecdefinition\(([^)]*)\)", p)]
        for spec in specs:
            keys = spec.split(" ASC")[0].split(" DESC")[0]
            # ("__range": one row per range of the look-back's scan)
            ok = "__b" in keys or keys.strip() == "__range" or ("campaign_id" in keys and "date" in keys) or keys.startswith("__u, __un") \
                or keys.startswith("__k, __k_null")
            assert ok, (name, spec)
        if name in ("session_channel_groups", "daily_sessions", "user_last_source"):
            assert p.count("Exchange SinglePartition") <= 1, name  # those rows alone
        else:
            assert "SinglePartition" not in p, name


def test_no_broadcast_from_planning_estimates(spark):
    """Before running, no plan broadcasts: only AQE, after measuring a join
    side's shuffle output, may turn a join into a broadcast."""
    for name in ("session_channel_groups", "daily_sessions", "gclid_campaigns", "base_events"):
        p = _plan(Q.run(spark, name, SF_SMALL))          # not executed: the initial adaptive plan
        assert "isFinalPlan=false" in p, name
        # (dynamic partition pruning may still ship its set of pruning values;
        # the event number ships its hot buckets, fewer than rows / 1,000,000; the
        # look-back what its ranges carry in, one row per range)
        assert p.count("BroadcastHashJoin") == {"base_events": 3, "gclid_campaigns": 0}.get(name, 2), name


def test_no_sliding_window_frames(spark):
    """Every window frame starts at UNBOUNDED PRECEDING (or is the whole
    partition): Spark evaluates those incrementally, while a frame with a
    bounded lower offset is re-aggregated whenever it changes."""
    for name in ("user_last_source", "session_channel_groups", "base_events", "ads_campaign_names",
                 "ads_campaign_names_ignore_nulls"):
        p = _plan(Q.run(spark, name, SF_SMALL))
        frames = re.findall(r"specifiedwindowframe\((\w+), ([^,]+), ([^)]+\)?)\)", p)
        assert frames, name
        for kind, lower, upper in frames:
            assert lower.startswith("unboundedpreceding"), (name, kind, lower, upper)
