"""Registered queries: one per operator of the inventory, each over tables
derived from the driver's ``events`` (and ``pages``).  Outputs are flat
(structs spread into columns) so value hashes compare across engines."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.config import DEV, FULL, INCREMENTAL, RunConfig, apply_window
from touchpath.functions import dates as D
from touchpath.functions.channels import custom_channel_group, default_channel_group
from touchpath.functions.params import event_param
from touchpath.operators import ads as A
from touchpath.operators import quality as Q
from touchpath.operators import sessions as S
from touchpath.operators.base_events import base_events, keyed_events
from touchpath.operators.dictionary import Dictionary
from touchpath.operators.reports import sessions_per_channel
from touchpath.plans.chain import FIXTURE_RUN_DATE, Chain, fixture_chain, fixture_registry
from touchpath.session import configure, scratch_path
from touchpath.sources import fixtures, ga4, sinks
from touchpath.sources.ads import SourceRegistry, resolve
from touchpath.streaming.campaign_state import CampaignNames
from touchpath.streaming.day_metrics import DayMetrics
from touchpath.streaming.incremental import IncrementalRunner
from touchpath.streaming.session_state import FirstLastState

RUN = FIXTURE_RUN_DATE
SHORT_LOOKBACK = 5 * 86_400


def _chain(spark: SparkSession, sf: str, **kw) -> Chain:
    return fixture_chain(spark, sf, **kw)


def _flat(struct_col: str, prefix: str) -> list[Column]:
    return [F.col(f"{struct_col}.{f}").alias(f"{prefix}_{f}")
            for f in ("source", "medium", "campaign", "page_pagetype")]


FLAT_BASE = ["event_date_dt", "event_timestamp", "event_name", "user_id", "user_pseudo_id", "page_device",
             "page_hostname", "stream_id", "ga_session_id", "page_location", "ga_session_number",
             "session_engaged", "engagement_time_msec", "page_title", "page_pagetype", "page_referrer",
             "user_key", "session_key", "session_event_number", "sk_id", "page_path",
             "page_path_and_querystring"]


# ---------------------------------------------------------------- sources / sinks
def q_src_event_shards(spark, sf):
    ch = _chain(spark, sf)
    root = scratch_path(spark, "event-shards")
    last = RUN - timedelta(days=1)
    ga4.write_ga4_shards(ch.raw_events, root, intraday_days=[last])
    lo, hi = D.last_n_days_bounds(RUN, 120)
    days = [lo + timedelta(days=i) for i in range((hi - lo).days + 1)]
    df = ga4.read_ga4_shards(spark, root, days=days, missing="leading")
    return df.select("shard_date", "event_date", "event_timestamp", "event_name", "user_id", "user_pseudo_id")


def q_ads_click_stats(spark, sf):
    return _chain(spark, sf).clicks


def q_ads_campaign_names(spark, sf):
    return _chain(spark, sf).campaign_names


def q_dev_sample(spark, sf):
    """A dev run of the keyed events: last two days, 5 % of the export by hash."""
    ch = _chain(spark, sf)
    return keyed_events(ch.raw_events, ch.cfg.with_(mode="dev")).select(
        "event_date_dt", "event_timestamp", "event_name", "session_key")


def q_dev_block_sample(spark, sf):
    """A dev run that samples blocks: of the last two days' shards, stored by the
    hour, a quarter of the hours is read."""
    ch = _chain(spark, sf)
    root = scratch_path(spark, "hourly-shards")
    days = [RUN - timedelta(days=i) for i in (1, 2)]
    ga4.write_ga4_shards(ch.raw_events.where(F.col("shard_date").isin(days)), root, by_hour=True)
    raw = ga4.read_ga4_shards(spark, root, days=days, schema=ga4.EXPORT_SCHEMA, sample_percent=25, sample_unit="folder")
    return keyed_events(raw, ch.cfg.with_(mode=DEV, dev_sampling="blocks")).select(
        "event_date_dt", "event_timestamp", "event_name", "session_key")


def q_src_declared_tables(spark, sf):
    """Rows of every declared ad-account table by its name; the entity and statistics
    tables that no model reads hold, here, each account's clicks."""
    configure(spark)
    base = fixture_registry(spark, sf)
    registry = SourceRegistry.declared("/not/there", shopping=["de", "at"])
    for name in registry.entries:
        kind = name[: -len(name.split("_")[-1]) - 1] if not name.endswith("_brand") else name.rsplit("_", 2)[0]
        account = name[len(kind) + 1:]
        registry.register(name, base.entries.get(name, base.entries[f"{SourceRegistry.CLICKS}{account}"]))
    out = None
    for name in registry.entries:
        part = registry.table(spark, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("source_table"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def q_sink_full_rebuild(spark, sf):
    """Two full loads into one location; the second replaces the first."""
    path = scratch_path(spark, "full-rebuild")
    early = _chain(spark, sf, cfg=RunConfig(run_date=date(2024, 1, 16)))
    sinks.write_full(early.silent_sessions, path, partition_by="event_date_dt", cluster_by=["session_key"])
    sinks.write_full(_chain(spark, sf).silent_sessions, path, partition_by="event_date_dt", cluster_by=["session_key"])
    return spark.read.parquet(path).select(*S.TRAFFIC_EVENT_COLUMNS)


def q_sink_dynamic_overwrite(spark, sf):
    """Full load, then an incremental load from the high-water mark that
    replaces only the partitions it produces."""
    path = scratch_path(spark, "dynamic")
    full = _chain(spark, sf)
    sinks.write_full(full.silent_sessions, path, partition_by="event_date_dt")
    hwm = sinks.high_water_mark(spark, path, "event_date_dt")
    inc = RunConfig(run_date=RUN, mode=INCREMENTAL,
                    high_water_marks={"non_pageview_sessions": hwm - timedelta(days=5)})
    # the base-events table holds the whole history; the silent-session model
    # reads it from the high-water mark on
    again = _chain(spark, sf, cfg=inc, overrides={"base": full.base})
    sinks.write_dynamic(again.silent_sessions, path, partition_by="event_date_dt")
    return spark.read.parquet(path).select(*S.TRAFFIC_EVENT_COLUMNS)


def q_sink_static_overwrite(spark, sf):
    """Full load of base events, then a reload of the two fixed days where one
    day no longer has input: that partition is emptied, the other replaced."""
    path = scratch_path(spark, "static")
    full = _chain(spark, sf)
    flat = lambda df: df.select(*FLAT_BASE)
    sinks.write_full(flat(full.base), path, partition_by="event_date_dt", cluster_by=["event_name"])
    gone = RUN - timedelta(days=2)
    raw2 = full.raw_events.where(F.col("shard_date") != F.lit(gone))
    inc = RunConfig(run_date=RUN, mode=INCREMENTAL)
    sinks.write_static(spark, flat(base_events(raw2, inc)), path, "event_date_dt", inc.reload_partitions(),
                       cluster_by=["event_name"])
    return spark.read.parquet(path).select(*FLAT_BASE)


def q_sink_schema_guard(spark, sf):
    """The guarded table after a second load, and that a changed type was refused."""
    path = scratch_path(spark, "guarded")
    daily = _chain(spark, sf).daily
    sinks.write_full(daily, path, partition_by="event_date_dt", guard_schema=True)
    sinks.write_dynamic(daily, path, partition_by="event_date_dt", guard_schema=True)
    changed = daily.withColumn("ga4_sessions", F.col("ga4_sessions").cast("string"))
    try:
        sinks.write_dynamic(changed, path, partition_by="event_date_dt", guard_schema=True)
        refused = False
    except sinks.SchemaChangeError:
        refused = True
    return spark.read.parquet(path).withColumn("refused", F.lit(refused))


def q_ads_click_stats_incremental(spark, sf):
    """The stored click table after a full load on the 27th and daily loads to
    the 31st, late clicks of older days included."""
    ch = _chain(spark, sf)
    runner = IncrementalRunner(spark, scratch_path(spark, "clicks-daily"), ch.raw_events, ch.click_tables, ch.campaign_tables)
    for day in range(27, 32):
        runner.load_clicks(date(2024, 1, day))
    return runner.table("ads_click_stats").select(*A.CLICK_COLUMNS, "sk_id")


def q_base_events_after_gap(spark, sf):
    """Stored base events of a load on the 27th and the next one on the 31st: the
    skipped days are loaded too.  (The event number restarts with the reload.)"""
    ch = _chain(spark, sf)
    runner = IncrementalRunner(spark, scratch_path(spark, "base-gap"), ch.raw_events, {}, {}, variant="urlparam")
    for day in (27, 31):
        runner.load_base(date(2024, 1, day))
    return runner.table("base_events").select(*[c for c in FLAT_BASE if c != "session_event_number"])


def q_run_mode_windows(spark, sf):
    """Page views by day that each run mode reads."""
    ch = _chain(spark, sf)
    out = None
    for mode in (FULL, INCREMENTAL, DEV):
        cfg = ch.cfg.with_(mode=mode, high_water_marks={"pageviews": date(2024, 1, 27)})
        part = _count_by_day(apply_window(ch.events.where(F.col("event_name") == "page_view"), cfg, "pageviews"), "event_date_dt")
        part = part.select(F.lit(mode).alias("mode"), "day", "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def q_high_water_mark(spark, sf):
    path = scratch_path(spark, "hwm")
    sinks.write_full(_chain(spark, sf).silent_sessions, path, partition_by="event_date_dt")
    hwm = sinks.high_water_mark(spark, path, "event_date_dt")
    return spark.range(1).select(F.lit(hwm).cast("date").alias("high_water_mark"))


# ---------------------------------------------------------------- projections / scalars
def q_extract_params(spark, sf):
    b = _chain(spark, sf).events
    from touchpath.functions.params import INT, event_param
    return b.select("event_timestamp", "ga_session_id", "page_location", "ga_session_number", "session_engaged",
                    "engagement_time_msec", "page_title", "page_pagetype", "page_referrer", "page_device",
                    "page_hostname",
                    *[event_param(k).alias(k) for k in ("source", "medium", "campaign", "gclid",
                                                         "session_gadscampaign", "session_gadsbraid")],
                    event_param("entrances", INT).alias("entrances"))


def q_scalar_dates(spark, sf):
    raw = _chain(spark, sf).raw_events.select("event_date").distinct()
    d = D.parse_yyyymmdd(F.col("event_date"))
    return raw.select(
        "event_date", d.alias("event_date_dt"),
        D.shard_date(F.concat(F.lit("tables/events_intraday_"), F.col("event_date"))).alias("shard_date"),
        D.first_number(F.concat(F.lit("intraday_"), F.col("event_date"))).alias("suffix_number"),
        F.date_sub(d, 120).alias("minus_120_days"),
        F.add_months(d, -12).alias("minus_1_year"))


def q_page_path(spark, sf):
    from touchpath.functions.paths import page_path, page_path_and_querystring
    site = RunConfig(run_date=RUN).site
    ev = _chain(spark, sf).raw_events.select(
        F.lit("events").alias("origin"), F.col("event_timestamp").alias("id"),
        event_param("page_location").alias("location"))
    pages = spark.read.parquet(f"{sf.rstrip('/')}/pages.parquet").select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("id"), F.col("url").alias("location"))
    u = ev.unionByName(pages)
    return u.select("origin", "id", "location", page_path(F.col("location"), site).alias("page_path"),
                    page_path_and_querystring(F.col("location"), site).alias("page_path_and_querystring"))


def q_identity_keys(spark, sf):
    return _chain(spark, sf).events.select("event_timestamp", "user_id", "user_pseudo_id", "ga_session_id",
                                         "user_key", "session_key")


def q_surrogate_key(spark, sf):
    return _chain(spark, sf).events.select("event_timestamp", "ga_session_id", "event_name",
                                         "engagement_time_msec", "sk_id")


# ---------------------------------------------------------------- filters
def _count_by_day(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(F.col(col).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))


def q_filter_last_n_days(spark, sf):
    raw = _chain(spark, sf).raw_events
    return _count_by_day(raw.where(D.last_n_days(F.col("shard_date"), RUN, 7)), "shard_date")


def q_filter_prev_year(spark, sf):
    raw = _chain(spark, sf).raw_events
    return _count_by_day(raw.where(D.last_n_days_prev_year(F.col("shard_date"), date(2025, 1, 15), 120)), "shard_date")


def q_filter_two_windows(spark, sf):
    ev = fixtures.load_events(spark, sf)
    clicks = fixtures.ads_click_stats(ev)
    from functools import reduce
    u = reduce(lambda a, b: a.unionByName(b), clicks.values())
    return _count_by_day(u.where(D.two_windows(F.col("_partition_date"), date(2025, 1, 20), 120)), "_partition_date")


def q_filter_partition_list(spark, sf):
    raw = _chain(spark, sf).raw_events
    return _count_by_day(raw.where(D.in_dates(F.col("shard_date"), RunConfig(run_date=RUN).reload_partitions())),
                         "shard_date")


def q_filter_incremental(spark, sf):
    b = _chain(spark, sf).events
    return _count_by_day(b.where(D.incremental_range(F.col("event_date_dt"), date(2024, 1, 27), RUN)), "event_date_dt")


def q_pageview_events(spark, sf):
    b = _chain(spark, sf).events
    return b.where(F.col("event_name") == "page_view").select("event_timestamp", "session_key", "page_path")


# ---------------------------------------------------------------- models
def q_session_event_number(spark, sf):
    return _chain(spark, sf).base.select("session_key", "event_timestamp", "session_event_number")


def q_base_events(spark, sf):
    return _chain(spark, sf).base.select(*FLAT_BASE)


def q_non_pageview_sessions(spark, sf):
    return _chain(spark, sf).silent_sessions


def q_ordered_string_agg(spark, sf):
    """Per session: the page-view marker's aggregate, and the names of all events
    and the paths of all pages in the order of their time (equal times by text)."""
    ch = _chain(spark, sf)
    keys = ["session_key", "user_key", "session_start_time"]
    ev = apply_window(ch.events, ch.cfg, "non_pageview_sessions").select(
        "session_key", "user_key", F.col("ga_session_id").alias("session_start_time"), "event_timestamp", "event_name", "page_path",
        F.when(F.col("event_name") == "page_view", F.col("event_name")).alias("marker"))
    lists = [S.ordered_string_agg(ev, keys, text, ["event_timestamp", text], out, sep)
             for text, out, sep in (("marker", "has_pageview", ","), ("event_name", "event_names", ","), ("page_path", "page_paths", " > "))]
    # each has one row per key: put side by side by one grouping (one sort a task,
    # where joins hold one per side)
    names = [df.columns[-1] for df in lists]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lists)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names])


def q_join_gclid_campaign(spark, sf):
    ch = _chain(spark, sf)
    pv = S.traffic_params(ch.traffic_events, ch.cfg)
    j = S.join_gclid_names(pv, S.gclid_name_table(ch.gclid_campaigns, ch.cfg), stored=True)
    return j.select("event_timestamp", "sk_id", "gclid", "gads_campaign_name")


def q_gclid_campaigns(spark, sf):
    return _chain(spark, sf).gclid_campaigns


def q_adjust_google_params(spark, sf):
    return _chain(spark, sf).adjusted


def q_adjust_google_params_urlparam(spark, sf):
    return _chain(spark, sf, variant="urlparam").adjusted


def q_adjust_google_params_urlparam_all_events(spark, sf):
    """Url-parameter variant without the page-view filter (literal behaviour)."""
    ch = _chain(spark, sf)
    return S.adjust_google_params_urlparam(ch.events, ch.cfg, pageviews_only=False)


def q_ads_campaign_names_ignore_nulls(spark, sf):
    """Campaign names with the last non-NULL name over earlier days."""
    ch = _chain(spark, sf)
    return A.ads_campaign_names(spark, ch.campaign_tables, ch.cfg, ignore_nulls=True)


def _campaign_names_daily(spark, sf, carry: bool) -> DataFrame:
    """Campaign names in three runs, the mark's day of the first being partial."""
    tables = _chain(spark, sf).campaign_tables
    root = scratch_path(spark, "campaign-names")
    day = F.col("_partition_date")
    for run, until, part in ((date(2024, 1, 27), date(2024, 1, 26), True), (date(2024, 1, 28), date(2024, 1, 27), False), (RUN, RUN, False)):
        there = (day < F.lit(until)) | ((day == F.lit(until)) & (F.col("campaign_id") % 3 != 0)) if part else day <= F.lit(until)
        names = CampaignNames(spark, root, {a: resolve(spark, t).where(there) for a, t in tables.items()}, carry)
        names.advance(run)
    return names.table()


def q_ads_campaign_names_daily(spark, sf):
    """Daily runs that read new snapshot days only: equal to the rebuild."""
    return _campaign_names_daily(spark, sf, carry=False)


def q_ads_campaign_names_carried(spark, sf):
    """The last name that was not NULL, carried from run to run by a state."""
    return _campaign_names_daily(spark, sf, carry=True)


def q_session_first_last_source_drop_null_keys(spark, sf):
    ch = _chain(spark, sf, cfg=RunConfig(run_date=RUN, drop_null_keys=True), durable=("traffic_events",))
    return _first_last_flat(ch.first_last)


def q_pageviews_with_silent_sessions(spark, sf):
    return _chain(spark, sf).traffic.drop("traffic_source_struct")


def q_traffic_struct(spark, sf):
    t = _chain(spark, sf).traffic
    return t.select("session_key", "event_timestamp", "sk_id", *_flat("traffic_source_struct", "ts"))


def _first_last_flat(fl: DataFrame) -> DataFrame:
    return fl.select("event_date_dt", "session_key", "user_key", "session_start_time", "event_no",
                     *_flat("first_value_session", "first"), *_flat("last_non_null_value_session", "last"))


def q_session_first_last_source(spark, sf):
    return _first_last_flat(_chain(spark, sf, durable=("traffic_events",)).first_last)


def q_session_first_last_source_daily(spark, sf):
    """First and last source kept as states: a load up to the 26th, whose own day
    was not complete, then two runs that reload from their last day on."""
    traffic = _chain(spark, sf, durable=("traffic_events", "traffic")).traffic
    state = FirstLastState(spark, scratch_path(spark, "first-last-daily"))
    day = F.col("event_date_dt")
    until = lambda n: traffic.where(day <= F.lit(date(2024, 1, n)))
    state.advance(until(26).where((day < F.lit(date(2024, 1, 26))) | (F.col("event_timestamp") % 3 != 0)))
    for since, last in ((26, 28), (28, 31)):
        state.advance(until(last), date(2024, 1, since))
    return _first_last_flat(state.table())


def q_user_last_source(spark, sf):
    ch = _chain(spark, sf)
    m6 = S.session_last_user_source(ch.first_last, ch.cfg, lookback_seconds=SHORT_LOOKBACK)
    return m6.select("event_date_dt", "user_key", "session_key", "session_start_time",
                     *_flat("last_non_direct_source_user", "lnd"))


def q_session_source(spark, sf):
    cg = _chain(spark, sf).channel_groups
    return cg.select("session_key", "session_source", "session_medium", "session_campaign", "session_page_pagetype")


def q_channel_group_custom(spark, sf):
    ch = _chain(spark, sf)
    combos = ch.adjusted.select("source", "medium", "campaign", "page_pagetype").distinct()
    return combos.select("*", custom_channel_group(F.col("source"), F.col("medium"), F.col("campaign"),
                                                   F.col("page_pagetype")).alias("channel_group"))


def _default_group_rows(spark, sf) -> DataFrame:
    f = fixtures.event_fields(fixtures.load_events(spark, sf))
    cat = F.get(F.array(F.lit(None).cast("string"), F.lit("SOURCE_CATEGORY_SOCIAL"), F.lit("SOURCE_CATEGORY_SHOPPING"),
                        F.lit("SOURCE_CATEGORY_VIDEO"), F.lit("SOURCE_CATEGORY_SEARCH")),
                (F.col("event_id") % 5).cast("int"))
    # mediums that no event has, for the rules that ask for them
    rare = F.get(F.array(F.lit("cpv"), F.lit("audio"), F.lit("web push")), (F.col("event_id") % 17).cast("int"))
    return f.select(F.when(rare.isNotNull(), F.lit("partner")).otherwise(F.col("source")).alias("source"),
                    F.coalesce(rare, F.col("medium")).alias("medium"), cat.alias("source_category"))


def q_channel_group_default(spark, sf):
    x = _default_group_rows(spark, sf)
    x = x.withColumn("channel_group", default_channel_group(F.col("source"), F.col("medium"), F.col("source_category")))
    return x.groupBy("source", "medium", "source_category", "channel_group").agg(F.count(F.lit(1)).alias("n_events"))


def _group_counts(rows: DataFrame, cols: list[str], rules) -> DataFrame:
    """Events per tuple and channel group, the rules run once per distinct tuple."""
    labelled = Dictionary(rows, cols, rules).apply(rows, "channel_group")
    return labelled.groupBy(*cols, "channel_group").agg(F.count(F.lit(1)).alias("n_events"))


def q_channel_group_custom_dictionary(spark, sf):
    adjusted = _chain(spark, sf, variant="urlparam").adjusted
    return _group_counts(adjusted, ["source", "medium", "campaign", "page_pagetype"], custom_channel_group)


def q_channel_group_default_dictionary(spark, sf):
    return _group_counts(_default_group_rows(spark, sf), ["source", "medium", "source_category"], default_channel_group)


CG_FLAT = ["event_date_dt", "session_key", "user_key", "session_start_time", "session_source", "session_medium",
           "session_campaign", "session_page_pagetype", "session_channel_group"]


def q_session_channel_groups(spark, sf):
    cg = _chain(spark, sf).channel_groups
    return cg.select(*CG_FLAT, *_flat("first_value_session", "first"), *_flat("last_non_direct_source_user", "lnd"))


def q_session_channel_group_counts(spark, sf):
    return sessions_per_channel(_chain(spark, sf).channel_groups)


def q_session_starts_enriched(spark, sf):
    return _chain(spark, sf).session_starts.drop("event_params")


def q_daily_sessions(spark, sf):
    return _chain(spark, sf).daily


# ---------------------------------------------------------------- data quality
def q_dq_day_coverage(spark, sf):
    ch = _chain(spark, sf)
    a = Q.day_coverage(ch.silent_sessions, "event_date_dt", date(2023, 12, 25), RUN, "day_coverage:silent_sessions")
    b = Q.day_coverage(ch.session_starts, "event_date_dt", RUN - timedelta(days=10), RUN, "day_coverage:session_starts")
    return a.unionByName(b)


def q_dq_not_null(spark, sf):
    t = _chain(spark, sf).traffic
    return Q.not_null(t, "session_key").unionByName(Q.not_null(t, "user_key"))


def q_dq_unique(spark, sf):
    ch = _chain(spark, sf)
    cond = F.col("event_date_dt").between(F.lit(RUN - timedelta(days=10)), F.lit(RUN - timedelta(days=1)))
    a = Q.unique(ch.session_starts, "sk_id", cond, severity="warn", warn_if=1000)
    b = Q.unique(ch.adjusted, "sk_id", name="unique:pageview_sk_id", severity="warn")
    return a.unionByName(b)


def q_dq_in_set(spark, sf):
    t = _chain(spark, sf).adjusted
    cond = (F.col("event_date_dt").between(F.lit(RUN - timedelta(days=7)), F.lit(RUN - timedelta(days=1)))
            & F.col("session_gadscampaign").isNotNull())
    a = Q.in_set(t, "session_gadscampaign", ["generic_paid_shopping", "generic_paid_search", "brand_paid_search"],
                 cond, severity="warn", warn_if=5)
    b = Q.in_set(t, "session_gadscampaign", ["generic_paid_search"], cond, name="in_set:search_only",
                 severity="warn", warn_if=5)
    return a.unionByName(b)


def q_dq_unique_proportion(spark, sf):
    ch = _chain(spark, sf)
    return (Q.unique_proportion(ch.channel_groups, "session_key", 1, 1, severity="warn")
            .unionByName(Q.unique_proportion(ch.adjusted, "session_key", 1, 1, name="unique_proportion:pageview_session_key",
                                             severity="warn")))


def q_dq_model_suite(spark, sf):
    ch = _chain(spark, sf)
    return Q.model_suite(ch.silent_sessions, ch.traffic, ch.channel_groups, ch.session_starts, RUN)


def q_dq_model_suite_observed(spark, sf):
    """The model tests from counts that were observed while a daily run wrote the
    models: a load for the 31st whose last three days are written anew."""
    ch = _chain(spark, sf, durable=("traffic_events", "traffic", "first_last"))
    root = scratch_path(spark, "dq-observed")
    metrics = DayMetrics(spark, root)
    models = {"silent_sessions": ch.silent_sessions, "traffic_events": ch.traffic, "session_channel_groups": ch.channel_groups,
              "session_starts": ch.session_starts}
    days = [RUN - timedelta(days=i) for i in (1, 2, 3)]
    day = F.col("event_date_dt")
    for model, df in models.items():
        path = f"{root}/{model}"
        sinks.write_full(df.where(~day.isin(days) | (F.xxhash64("session_key") % 2 == 0)), path)
        if model in metrics.MODELS:
            metrics.rebuild(model, spark.read.parquet(path))
        observe = metrics.observation(model, days)
        sinks.write_static(spark, df.where(day.isin(days)), path, "event_date_dt", days, observe=observe)
        if observe is not None:
            metrics.record(model, days, observe[0], emptied=True)
    return metrics.suite(lambda model: spark.read.parquet(f"{root}/{model}"), RUN)


def q_dq_source_day_coverage(spark, sf):
    """Every day since the start date has rows, per click and shopping-product
    table of the registry."""
    configure(spark)
    registry = fixture_registry(spark, sf)
    return Q.source_day_coverage(registry.clicks, "segments_date", date(2023, 12, 1), RUN, "click_stats").unionByName(
        Q.source_day_coverage(registry.shopping, "segments_date", Q.SHOPPING_SINCE, RUN, "shopping_products"))


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)}


def run(spark: SparkSession, name: str, sf: str) -> DataFrame:
    configure(spark)
    return QUERIES[name](spark, sf)
