"""Incremental runner: late hits are reloaded, untouched days stay, base = full."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from touchpath.config import RunConfig
from touchpath.operators.base_events import base_events
from touchpath.plans.chain import fixture_chain
from touchpath.session import scratch_path
from touchpath.streaming.incremental import IncrementalRunner


def test_incremental_reload_picks_up_late_hits(spark):
    ch = fixture_chain(spark, SF_SMALL)
    raw = ch.raw_events
    late_day = date(2024, 1, 20)
    # first run (run date 21st): a third of the events of the 20th have not arrived yet
    early = raw.where(~((F.col("shard_date") == F.lit(late_day)) & (F.col("event_timestamp") % 3 == 0)))
    root = scratch_path(spark, "t-incremental")
    r1 = IncrementalRunner(spark, root, early, ch.click_tables, ch.campaign_tables)
    r1.run(date(2024, 1, 21))
    n_before = r1.table("base_events").where(F.col("event_date_dt") == F.lit(late_day)).count()
    # next run (22nd) sees the complete export: the 20th and 21st are reloaded
    r2 = IncrementalRunner(spark, root, raw, ch.click_tables, ch.campaign_tables)
    r2.run(date(2024, 1, 22))
    base_inc = r2.table("base_events")
    full = base_events(raw, RunConfig(run_date=date(2024, 1, 22)))
    n_after = base_inc.where(F.col("event_date_dt") == F.lit(late_day)).count()
    n_full = full.where(F.col("event_date_dt") == F.lit(late_day)).count()
    assert n_before < n_after == n_full
    cols = ["sk_id", "session_key", "user_key", "page_path", "event_date_dt"]
    assert base_inc.select(*cols).exceptAll(full.select(*cols)).count() == 0
    assert full.select(*cols).exceptAll(base_inc.select(*cols)).count() == 0
    cg = r2.table("session_channel_groups")
    assert cg.agg(F.max("event_date_dt")).first()[0] == date(2024, 1, 21)
    assert cg.groupBy("session_key").count().where("count > 1 and session_key is not null").count() == 0


def test_durable_boundaries_give_the_same_result(spark):
    lazy = fixture_chain(spark, SF_SMALL)
    durable = fixture_chain(spark, SF_SMALL, durable=("base", "traffic", "first_last"))
    cols = ["session_key", "user_key", "session_source", "session_medium", "session_campaign", "session_channel_group"]
    a, b = lazy.channel_groups.select(*cols), durable.channel_groups.select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    a, b = lazy.daily, durable.daily
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_daily_incremental_equals_full_refresh_urlparam(spark):
    """Full load on the 28th, then daily runs to the 31st: the channel-group
    table equals a full refresh on the 31st (url-parameter variant; partial
    days only add silent-session rows that never change first/last source)."""
    ch = fixture_chain(spark, SF_SMALL, variant="urlparam")
    root = scratch_path(spark, "t-inc-eq")
    runner = IncrementalRunner(spark, root, ch.raw_events, {}, {}, variant="urlparam")
    runner.backfill(date(2024, 1, 28), date(2024, 1, 31), with_tests=False)
    full = fixture_chain(spark, SF_SMALL, variant="urlparam").channel_groups
    cols = ["event_date_dt", "session_key", "user_key", "session_start_time", "session_source", "session_medium",
            "session_campaign", "session_page_pagetype", "session_channel_group"]
    inc = runner.table("session_channel_groups").where(
        F.col("event_date_dt").between(F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 30)))).select(*cols)
    full = full.select(*cols)
    assert inc.count() == full.count()
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


def test_bounded_first_last_history_keeps_channel_groups(spark):
    # run on 20 Feb: the 30-day window starts on 21 Jan; with a 5-day look-back
    # a 37-day bound drops 1-13 Jan from the first/last input, which must not
    # change any channel group of the window
    cfg = RunConfig(run_date=date(2024, 2, 20), lookback_seconds=5 * 86400)
    full = fixture_chain(spark, SF_SMALL, cfg=cfg)
    short = fixture_chain(spark, SF_SMALL, cfg=cfg.with_(first_last_days=30 + 5 + 2))
    assert short.first_last.count() == full.first_last.count()
    assert short.last_user_source.count() < full.last_user_source.count()
    cols = ["session_key", "session_source", "session_medium", "session_campaign", "session_channel_group"]
    x, y = full.channel_groups.select(*cols), short.channel_groups.select(*cols)
    assert x.count() > 0
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_too_short_a_history_is_refused():
    day = date(2024, 2, 20)
    assert RunConfig(run_date=day, first_last_days=122).first_last_days == 122
    for kw in ({"first_last_days": 121}, {"first_last_days": 10}, {"first_last_days": 36, "lookback_seconds": 5 * 86400}, {"reload_days": 0}):
        with pytest.raises(ValueError):
            RunConfig(run_date=day, **kw)


def _same(a, b, cols):
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("days", [(27, 28, 29, 30, 31), (27, 31), (26, 28, 31)])
def test_every_stored_table_equals_a_full_refresh(spark, days):
    """Daily loads, and loads with skipped days in between, end with the tables
    of a full refresh: late clicks, late hits and silent sessions included."""
    ch = fixture_chain(spark, SF_SMALL)
    cfg = RunConfig(run_date=date(2024, 1, 31), click_lookback_days=120, widen_sessions_days=120)
    tables = {}
    for name, runs in (("daily", days), ("full", (31,))):
        r = IncrementalRunner(spark, scratch_path(spark, f"t-all-{name}"), ch.raw_events, ch.click_tables, ch.campaign_tables, base_cfg=cfg)
        for d in runs:
            r.run(date(2024, 1, d), with_tests=False)
        tables[name] = r
    skip = {"event_params", "device", "items", "ecommerce", "session_event_number"}
    for model in ("ads_click_stats", "ads_campaign_names", "base_events", "session_channel_groups"):
        a, b = tables["daily"].table(model), tables["full"].table(model)
        cols = [c for c, t in a.dtypes if c not in skip and not t.startswith("struct")]
        assert a.count() == b.count(), model
        assert _same(a, b, cols), model
    # page views before the high-water mark are not rewritten (as in the
    # original), so a click that comes later names no older page view; but none
    # is missing
    a, b = (tables[k].table("traffic_events").where("event_name IS NOT NULL").select("event_date_dt", "session_key", "event_timestamp", "sk_id").distinct()
            for k in ("daily", "full"))
    assert _same(a, b, a.columns)


def test_going_back_in_time_is_refused(spark):
    ch = fixture_chain(spark, SF_SMALL)
    r = IncrementalRunner(spark, scratch_path(spark, "t-back"), ch.raw_events, {}, {}, variant="urlparam")
    r.load_base(date(2024, 1, 20))
    assert r.reload_days(date(2024, 1, 24)) == [date(2024, 1, d) for d in (23, 22, 21, 20, 19)]
    with pytest.raises(ValueError):
        r.load_base(date(2024, 1, 10))


def test_daily_incremental_equals_full_refresh_gclid_with_click_lookback(spark):
    """Ad-name variant: an incremental run only matches clicks from its
    high-water mark on (D15); with ``click_lookback_days`` covering the click
    history, daily runs equal a full refresh again."""
    ch = fixture_chain(spark, SF_SMALL)
    root = scratch_path(spark, "t-inc-eq-gclid")
    runner = IncrementalRunner(spark, root, ch.raw_events, ch.click_tables, ch.campaign_tables, variant="gclid",
                               base_cfg=RunConfig(run_date=date(2024, 1, 28), click_lookback_days=120))
    for day in (28, 29, 30, 31):
        runner.run(date(2024, 1, day), with_tests=False)
    cols = ["event_date_dt", "session_key", "session_source", "session_medium", "session_campaign",
            "session_channel_group"]
    full = fixture_chain(spark, SF_SMALL).channel_groups.select(*cols)
    inc = runner.table("session_channel_groups").where(
        F.col("event_date_dt").between(F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 30)))).select(*cols)
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


def test_widen_sessions_days_finds_groups_of_earlier_sessions(spark):
    """D16: both sides of the session-start join are cut to the same window,
    so a start inside it whose session began before it has no group."""
    from touchpath.operators import sessions as S
    ch = fixture_chain(spark, SF_SMALL)
    hwm = {"session_starts": date(2024, 1, 25)}
    missing = {}
    for widen in (0, 1):
        cfg = RunConfig(run_date=date(2024, 1, 31), mode="incremental", high_water_marks=hwm,
                        widen_sessions_days=widen)
        starts = S.session_starts_enriched(ch.events, ch.channel_groups, cfg)
        missing[widen] = starts.where(F.col("session_channel_group").isNull()
                                      & F.col("session_key").isNotNull()).count()
    assert missing[1] < missing[0]


def test_incremental_refuses_schema_change(spark):
    from touchpath.sources.sinks import SchemaChangeError
    ch = fixture_chain(spark, SF_SMALL, variant="urlparam")
    root = scratch_path(spark, "t-inc-schema")
    IncrementalRunner(spark, root, ch.raw_events, {}, {}, variant="urlparam").run(date(2024, 1, 30), with_tests=False)
    changed = ch.raw_events.withColumn("stream_id", F.lit(1))          # string -> int
    with pytest.raises(SchemaChangeError):
        IncrementalRunner(spark, root, changed, {}, {}, variant="urlparam").run(date(2024, 1, 31), with_tests=False)
