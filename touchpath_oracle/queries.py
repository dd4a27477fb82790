"""Oracle SQL per registered query (DuckDB, on the driver's views)."""

from __future__ import annotations

from datetime import date, timedelta

from touchpath_oracle.ctes import (FIXTURE, NM, RUN, SITE_RE, ads_ctes, base_ctes, d, default_case, custom_case, last_n,
                         prev_year, session_ctes, silent_cte, traffic_ctes, with_chain)

FLAT_BASE = ("event_date_dt, event_timestamp, event_name, user_id, user_pseudo_id, page_device, page_hostname, "
             "'1234567' AS stream_id, ga_session_id, page_location, ga_session_number, session_engaged, "
             "engagement_time_msec, page_title, page_pagetype, page_referrer, user_key, session_key, "
             "session_event_number, sk_id, page_path, page_path_and_querystring")
TRAFFIC_COLS = ("event_date_dt, session_key, user_key, event_timestamp, event_name, page_pagetype, "
                "session_start_time, gclid, session_gadscampaign, session_gadsbraid, entrances, "
                "page_referrer, page_location, source, medium, campaign")


def flat(s: str, p: str) -> str:
    return ", ".join(f"{s}.{f} AS {p}_{f}" for f in ("source", "medium", "campaign", "page_pagetype"))


def count_by_day(src: str, col: str, where: str) -> str:
    return f"SELECT {col} AS day, count(*) AS n_rows FROM {src} WHERE {where} GROUP BY {col}"


def status(n: str, severity: str, warn_if: int = 0, error_if: int = 0) -> str:
    warn = f"CASE WHEN {n} > {warn_if} THEN 'warn' ELSE 'pass' END"
    if severity == "error":
        return f"CASE WHEN {n} > {error_if} THEN 'fail' ELSE {warn} END"
    return warn


def dq(name: str, n_expr: str, src: str, severity: str, warn_if: int = 0, error_if: int = 0) -> str:
    return (f"SELECT '{name}' AS \"check\", n_failed, {status('n_failed', severity, warn_if, error_if)} AS status "
            f"FROM (SELECT CAST(coalesce({n_expr}, 0) AS BIGINT) AS n_failed FROM {src})")


def day_coverage(name: str, src: str, start: date, end: date) -> str:
    last = end - timedelta(days=1)
    return dq(name, "count(*)",
              f"(SELECT s.d FROM (SELECT CAST(unnest(generate_series({d(start)}, {d(last)}, INTERVAL 1 DAY)) AS DATE) AS d) s "
              f"WHERE s.d NOT IN (SELECT event_date_dt FROM {src} WHERE event_date_dt BETWEEN {d(start)} AND {d(last)}))",
              "warn")


STATIC_GONE = RUN - timedelta(days=2)
INC_HWM = date(2024, 1, 25)

URL_GROUPS = with_chain(
    f"SELECT source, medium, campaign, page_pagetype, {custom_case('source', 'medium', 'campaign', 'page_pagetype')} AS channel_group, "
    "count(*) AS n_events FROM adjusted_url GROUP BY ALL")
DEFAULT_GROUPS = "WITH " + FIXTURE + """,
x AS (SELECT CASE WHEN event_id % 17 < 3 THEN 'partner' ELSE source END AS source,
        CASE event_id % 17 WHEN 0 THEN 'cpv' WHEN 1 THEN 'audio' WHEN 2 THEN 'web push' ELSE medium END AS medium, CASE event_id % 5 WHEN 1 THEN 'SOURCE_CATEGORY_SOCIAL' WHEN 2 THEN 'SOURCE_CATEGORY_SHOPPING'
        WHEN 3 THEN 'SOURCE_CATEGORY_VIDEO' WHEN 4 THEN 'SOURCE_CATEGORY_SEARCH' END AS source_category FROM ga4)
SELECT source, medium, source_category, """ + default_case("source", "medium", "source_category") + """ AS channel_group,
  count(*) AS n_events
FROM x GROUP BY ALL"""


ORACLES: dict[str, str] = {
    "src_event_shards": "WITH " + FIXTURE + "\nSELECT event_date_dt AS shard_date, event_date, event_timestamp, "
                        "event_name, user_id, user_pseudo_id FROM ga4",
    "ads_click_stats": with_chain("SELECT * FROM clicks"),
    "ads_campaign_names": with_chain("SELECT * FROM names"),
    "sink_full_rebuild": with_chain(f"SELECT {TRAFFIC_COLS} FROM silent"),
    "sink_dynamic_overwrite": with_chain(
        f"SELECT {TRAFFIC_COLS} FROM silent WHERE event_date_dt NOT IN (SELECT DISTINCT event_date_dt FROM silent_inc) "
        f"UNION ALL SELECT {TRAFFIC_COLS} FROM silent_inc",
        extra=silent_cte("silent_inc", "base", f"event_date_dt BETWEEN {d(INC_HWM)} AND {d(RUN - timedelta(days=1))}")),
    "sink_static_overwrite": with_chain(
        f"SELECT {FLAT_BASE} FROM base WHERE event_date_dt NOT IN ({d(RUN - timedelta(days=1))}, {d(STATIC_GONE)}) "
        f"UNION ALL SELECT {FLAT_BASE} FROM base_inc",
        extra=base_ctes("base_inc", "ga4", f"event_date_dt IN ({d(RUN - timedelta(days=1))})")),
    "sink_schema_guard": with_chain("SELECT *, true AS refused FROM m12"),
    "ads_click_stats_incremental": with_chain("SELECT * FROM clicks"),
    "base_events_after_gap": with_chain(f"SELECT {FLAT_BASE.replace('session_event_number, ', '')} FROM base"),
    "run_mode_windows": with_chain(" UNION ALL ".join(
        f"SELECT '{mode}' AS mode, event_date_dt AS day, count(*) AS n_rows FROM base WHERE event_name = 'page_view' AND {w} GROUP BY event_date_dt"
        for mode, w in (("full", last_n("event_date_dt", RUN, 120)), ("dev", last_n("event_date_dt", RUN, 2)),
                        ("incremental", f"event_date_dt BETWEEN DATE '2024-01-27' AND {d(RUN - timedelta(days=1))}")))),
    "dev_sample": with_chain(
        "SELECT event_date_dt, event_timestamp, event_name, session_key FROM base "
        f"WHERE {last_n('event_date_dt', RUN, 2)} AND CAST('0x' || substr(md5('42|' || CAST(event_timestamp AS VARCHAR) || '|' "
        "|| event_name || '|' || coalesce(user_id, '') || '|' || coalesce(user_pseudo_id, '')), 1, 8) AS BIGINT) % 10000 < 500"),
    "dev_block_sample": with_chain(
        "SELECT event_date_dt, event_timestamp, event_name, session_key FROM sampled WHERE place < 2500 OR place = least",
        extra=f"""sampled AS (
  SELECT *, min(place) OVER () AS least FROM (
    SELECT *, CAST('0x' || substr(md5('42|shard=events_' || strftime(event_date_dt, '%Y%m%d') || '/hour='
        || CAST((event_timestamp // 3600000000) % 24 AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS place
    FROM base WHERE {last_n('event_date_dt', RUN, 2)}))"""),
    "src_declared_tables": with_chain(" UNION ALL ".join(
        [f"SELECT '{kind}_{a}' AS source_table, count(*) AS n_rows FROM clicks_raw WHERE account = '{a}'"
         for a in ("de", "at") for kind in ("click_stats", "search_query_stats", "campaign_stats", "ad_stats", "ads", "ad_groups",
                                            "ad_group_stats", "criteria", "keywords")]
        + [f"SELECT 'click_stats_{a}', count(*) FROM clicks_raw WHERE account = '{a}'" for a in ("de_brand", "at_brand", "ch_brand")]
        + ["SELECT 'geo_stats_de_brand', count(*) FROM clicks_raw WHERE account = 'de_brand'"]
        + [f"SELECT 'campaigns_{a}', count(*) FROM camp_raw WHERE acc = {i}" for i, a in enumerate(("de", "at", "de_brand", "at_brand", "ch_brand"))]
        + [f"SELECT 'shopping_products_{a}', count(*) FROM ga4 WHERE event_name = 'purchase' AND event_id % 2 = {i}" for i, a in enumerate(("de", "at"))])),
    "high_water_mark": with_chain("SELECT max(event_date_dt) AS high_water_mark FROM silent"),
    "extract_params": with_chain(
        "SELECT event_timestamp, ga_session_id, page_location, ga_session_number, session_engaged, engagement_time_msec, "
        "page_title, page_pagetype, page_referrer, page_device, page_hostname, source, medium, campaign, gclid, "
        "session_gadscampaign, session_gadsbraid, entrances FROM base"),
    "scalar_dates": "WITH " + FIXTURE + """
SELECT event_date, CAST(strptime(event_date, '%Y%m%d') AS DATE) AS event_date_dt,
  CAST(strptime(regexp_extract('tables/events_intraday_' || event_date, 'events_(?:intraday_)?([0-9]{8})', 1), '%Y%m%d') AS DATE) AS shard_date,
  nullif(regexp_extract('intraday_' || event_date, '[0-9]+', 0), '') AS suffix_number,
  CAST(CAST(strptime(event_date, '%Y%m%d') AS DATE) - INTERVAL 120 DAY AS DATE) AS minus_120_days,
  CAST(CAST(strptime(event_date, '%Y%m%d') AS DATE) - INTERVAL 1 YEAR AS DATE) AS minus_1_year
FROM (SELECT DISTINCT event_date FROM ga4)""",
    "page_path": "WITH " + FIXTURE + f""",
u AS (SELECT 'events' AS origin, event_timestamp AS id, page_location AS location FROM ga4
      UNION ALL SELECT 'pages', page_id, url FROM pages)
SELECT origin, id, location,
  regexp_replace(split_part(location, '?', 1), '{SITE_RE}', '') AS page_path,
  regexp_replace(location, '{SITE_RE}', '') AS page_path_and_querystring
FROM u""",
    "identity_keys": with_chain("SELECT event_timestamp, user_id, user_pseudo_id, ga_session_id, user_key, session_key FROM base"),
    "surrogate_key": with_chain("SELECT event_timestamp, ga_session_id, event_name, engagement_time_msec, sk_id FROM base"),
    "filter_last_n_days": "WITH " + FIXTURE + "\n" + count_by_day("ga4", "event_date_dt", last_n("event_date_dt", RUN, 7)),
    "filter_prev_year": "WITH " + FIXTURE + "\n" + count_by_day("ga4", "event_date_dt", prev_year("event_date_dt", date(2025, 1, 15), 120)),
    "filter_two_windows": with_chain(count_by_day(
        "clicks_raw", "_partition_date",
        f"({last_n('_partition_date', date(2025, 1, 20), 120)}) OR ({prev_year('_partition_date', date(2025, 1, 20), 120)})")),
    "filter_partition_list": "WITH " + FIXTURE + "\n" + count_by_day(
        "ga4", "event_date_dt", f"event_date_dt IN ({d(RUN - timedelta(days=1))}, {d(RUN - timedelta(days=2))})"),
    "filter_incremental": with_chain(count_by_day(
        "base", "event_date_dt", f"event_date_dt BETWEEN DATE '2024-01-27' AND {d(RUN - timedelta(days=1))}")),
    "pageview_events": with_chain("SELECT event_timestamp, session_key, page_path FROM base WHERE event_name = 'page_view'"),
    "session_event_number": with_chain("SELECT session_key, event_timestamp, session_event_number FROM base"),
    "base_events": with_chain(f"SELECT {FLAT_BASE} FROM base"),
    "non_pageview_sessions": with_chain(f"SELECT {TRAFFIC_COLS} FROM silent"),
    "ordered_string_agg": with_chain(
        "SELECT session_key, user_key, ga_session_id AS session_start_time, "
        "string_agg(CASE WHEN event_name = 'page_view' THEN event_name END, ',' ORDER BY event_timestamp) AS has_pageview, "
        "string_agg(event_name, ',' ORDER BY event_timestamp, event_name) AS event_names, "
        "string_agg(page_path, ' > ' ORDER BY event_timestamp, page_path) AS page_paths "
        f"FROM base WHERE {last_n('event_date_dt', RUN, 30)} GROUP BY session_key, user_key, ga_session_id"),
    "join_gclid_campaign": with_chain("SELECT event_timestamp, sk_id, gclid, gads_campaign_name FROM pvj"),
    "gclid_campaigns": with_chain("SELECT * FROM gclid_campaigns"),
    "adjust_google_params": with_chain(f"SELECT {TRAFFIC_COLS}, sk_id FROM adjusted"),
    "adjust_google_params_urlparam": with_chain(f"SELECT {TRAFFIC_COLS}, sk_id FROM adjusted_url"),
    "adjust_google_params_urlparam_all_events": with_chain(f"SELECT {TRAFFIC_COLS}, sk_id FROM adjusted_url_all"),
    "ads_campaign_names_ignore_nulls": with_chain("SELECT * FROM names_nn"),
    "ads_campaign_names_daily": with_chain("SELECT * FROM names"),
    "ads_campaign_names_carried": with_chain("SELECT * FROM names_nn"),
    "session_first_last_source_drop_null_keys": with_chain(
        "SELECT event_date_dt, session_key, user_key, session_start_time, event_no, "
        f"{flat('first_value_session', 'first')}, {flat('last_non_null_value_session', 'last')} FROM m5 "
        "WHERE session_key IS NOT NULL"),
    "pageviews_with_silent_sessions": with_chain(f"SELECT {TRAFFIC_COLS}, sk_id FROM traffic"),
    "traffic_struct": with_chain(f"SELECT session_key, event_timestamp, sk_id, {flat('tss', 'ts')} FROM traffic"),
    "session_first_last_source": with_chain(
        "SELECT event_date_dt, session_key, user_key, session_start_time, event_no, "
        f"{flat('first_value_session', 'first')}, {flat('last_non_null_value_session', 'last')} FROM m5"),
    "session_first_last_source_daily": with_chain(
        "SELECT event_date_dt, session_key, user_key, session_start_time, event_no, "
        f"{flat('first_value_session', 'first')}, {flat('last_non_null_value_session', 'last')} FROM m5"),
    "user_last_source": with_chain(
        f"SELECT event_date_dt, user_key, session_key, session_start_time, {flat('last_non_direct_source_user', 'lnd')} FROM m6",
        lookback=5 * 86_400),
    "session_source": with_chain("SELECT session_key, session_source, session_medium, session_campaign, session_page_pagetype FROM m7"),
    "channel_group_custom": with_chain(
        "SELECT source, medium, campaign, page_pagetype, "
        f"{custom_case('source', 'medium', 'campaign', 'page_pagetype')} AS channel_group "
        "FROM (SELECT DISTINCT source, medium, campaign, page_pagetype FROM adjusted)"),
    "channel_group_custom_dictionary": URL_GROUPS,
    "channel_group_default_dictionary": DEFAULT_GROUPS,
    "channel_group_default": DEFAULT_GROUPS,
    "session_channel_groups": with_chain(
        "SELECT event_date_dt, session_key, user_key, session_start_time, session_source, session_medium, session_campaign, "
        f"session_page_pagetype, session_channel_group, {flat('first_value_session', 'first')}, "
        f"{flat('last_non_direct_source_user', 'lnd')} FROM m7"),
    "session_channel_group_counts": with_chain(
        "SELECT session_channel_group, count(*) AS sessions FROM m7 GROUP BY session_channel_group"),
    "session_starts_enriched": with_chain("SELECT * FROM m8"),
    "daily_sessions": with_chain("SELECT * FROM m12"),
    "dq_day_coverage": with_chain(
        day_coverage("day_coverage:silent_sessions", "silent", date(2023, 12, 25), RUN) + " UNION ALL "
        + day_coverage("day_coverage:session_starts", "m8", RUN - timedelta(days=10), RUN)),
    "dq_not_null": with_chain(
        dq("not_null:session_key", "count(*) FILTER (WHERE session_key IS NULL)", "traffic", "error") + " UNION ALL "
        + dq("not_null:user_key", "count(*) FILTER (WHERE user_key IS NULL)", "traffic", "error")),
    "dq_unique": with_chain(
        dq("unique:sk_id", "count(*)",
           f"(SELECT sk_id FROM m8 WHERE event_date_dt BETWEEN {d(RUN - timedelta(days=10))} AND {d(RUN - timedelta(days=1))} "
           "AND sk_id IS NOT NULL GROUP BY sk_id HAVING count(*) > 1)", "warn", 1000) + " UNION ALL "
        + dq("unique:pageview_sk_id", "count(*)",
             "(SELECT sk_id FROM adjusted WHERE sk_id IS NOT NULL GROUP BY sk_id HAVING count(*) > 1)", "warn")),
    "dq_in_set": with_chain(
        dq("in_set:session_gadscampaign",
           "count(*) FILTER (WHERE session_gadscampaign NOT IN ('generic_paid_shopping', 'generic_paid_search', 'brand_paid_search'))",
           f"(SELECT * FROM adjusted WHERE event_date_dt BETWEEN {d(RUN - timedelta(days=7))} AND {d(RUN - timedelta(days=1))} "
           "AND session_gadscampaign IS NOT NULL)", "warn", 5) + " UNION ALL "
        + dq("in_set:search_only", "count(*) FILTER (WHERE session_gadscampaign NOT IN ('generic_paid_search'))",
             f"(SELECT * FROM adjusted WHERE event_date_dt BETWEEN {d(RUN - timedelta(days=7))} AND {d(RUN - timedelta(days=1))} "
             "AND session_gadscampaign IS NOT NULL)", "warn", 5)),
    "dq_model_suite": with_chain(" UNION ALL ".join([
        day_coverage("silent_sessions:day_coverage", "silent", RUN - timedelta(days=30), RUN),
        day_coverage("pageviews:day_coverage", "traffic", RUN - timedelta(days=44), RUN),
        dq("pageviews:session_gadscampaign_in_set",
           "count(*) FILTER (WHERE session_gadscampaign NOT IN ('generic_paid_shopping', 'generic_paid_search', 'brand_paid_search'))",
           f"(SELECT * FROM traffic WHERE event_date_dt BETWEEN {d(RUN - timedelta(days=7))} AND {d(RUN - timedelta(days=1))} "
           "AND session_gadscampaign IS NOT NULL)", "warn", 5),
        dq("pageviews:session_key_not_null", "count(*) FILTER (WHERE session_key IS NULL)", "traffic", "error"),
        dq("pageviews:user_key_not_null", "count(*) FILTER (WHERE user_key IS NULL)", "traffic", "error"),
        dq("channel_groups:session_key_unique_proportion",
           "CASE WHEN count(DISTINCT session_key) * 1.0 / count(session_key) IS NULL "
           "OR count(DISTINCT session_key) * 1.0 / count(session_key) <> 1 THEN 1 ELSE 0 END", "m7", "warn"),
        day_coverage("session_starts:day_coverage", "m8", RUN - timedelta(days=10), RUN),
        dq("session_starts:sk_id_not_null", "count(*) FILTER (WHERE sk_id IS NULL)", "m8", "error"),
        dq("session_starts:sk_id_unique", "count(*)",
           f"(SELECT sk_id FROM m8 WHERE event_date_dt BETWEEN {d(RUN - timedelta(days=10))} AND {d(RUN - timedelta(days=1))} "
           "AND sk_id IS NOT NULL GROUP BY sk_id HAVING count(*) > 1)", "warn", 1000),
    ])),
    "dq_source_day_coverage": with_chain(" UNION ALL ".join(
        day_coverage(f"click_stats_{a}:day_coverage", f"(SELECT segments_date AS event_date_dt FROM clicks_raw WHERE account = '{a}')",
                     date(2023, 12, 1), RUN)
        for a in ("de", "at", "de_brand", "at_brand", "ch_brand")) + " UNION ALL " + " UNION ALL ".join(
        day_coverage(f"shopping_products_{a}:day_coverage",
                     f"(SELECT event_date_dt FROM ga4 WHERE event_name = 'purchase' AND event_id % 2 = {i})", date(2022, 7, 1), RUN)
        for i, a in enumerate(("de", "at")))),
    "dq_unique_proportion": with_chain(
        dq("unique_proportion:session_key",
           "CASE WHEN count(DISTINCT session_key) * 1.0 / count(session_key) IS NULL "
           "OR count(DISTINCT session_key) * 1.0 / count(session_key) <> 1 THEN 1 ELSE 0 END", "m7", "warn")
        + " UNION ALL "
        + dq("unique_proportion:pageview_session_key",
             "CASE WHEN count(DISTINCT session_key) * 1.0 / count(session_key) IS NULL "
             "OR count(DISTINCT session_key) * 1.0 / count(session_key) <> 1 THEN 1 ELSE 0 END", "adjusted", "warn")),
}

ORACLES["dq_model_suite_observed"] = ORACLES["dq_model_suite"]
