"""DuckDB oracle: the fixture and every model rebuilt in plain SQL.

Independent of the Spark code: the fixture is computed flat (no parameter
array), first/last values use window functions with IGNORE NULLS, silent
sessions use an ordered STRING_AGG, joins use USING.  Each query text is the
CTE library followed by one final SELECT; the views of the driver (events,
pages, ...) are the only inputs.
"""

from __future__ import annotations

from datetime import date, timedelta

NM = "'_dbt_utils_surrogate_key_null_'"
RUN = date(2024, 1, 31)
SITE_RE = "^http[s]?://www.shop.[a-z][a-z][.]?[a-z]?[a-z]?"
ACCOUNTS = ("de", "at", "de_brand", "at_brand", "ch_brand")


def d(x: date) -> str:
    return f"DATE '{x.isoformat()}'"


def last_n(col: str, run: date, n: int) -> str:
    return f"{col} BETWEEN {d(run - timedelta(days=n))} AND {d(run - timedelta(days=1))}"


def prev_year(col: str, run: date, n: int) -> str:
    try:
        py = run.replace(year=run.year - 1)
    except ValueError:
        py = run.replace(year=run.year - 1, day=28)
    return f"{col} BETWEEN {d(py - timedelta(days=n))} AND {d(py)}"


LOOKUP = """
lk(n, l_source, l_medium, l_campaign) AS (VALUES
 (0,'google','cpc','x_2_de'), (1,'google','cpc','x_4_de'), (2,'google','cpc','x_5_de'),
 (3,'google','cpc','brand_paid_search'), (4,'google','cpc',NULL), (5,'bing','cpc','x_2_de'),
 (6,'bing','cpc','x_1_de'), (7,'bing','cpc',NULL), (8,'google','organic',NULL),
 (9,'google','organic',NULL), (10,'duckduckgo','organic',NULL), (11,'startpage.com','referral',NULL),
 (12,'google','organic','google_shopping_organic'), (13,'newsletter','email','y24_kw12'),
 (14,'crm','email','a_kw_ns_b'), (15,'parcellab','email',NULL), (16,'triggermail','email',NULL),
 (17,'facebook','cpc',NULL), (18,'instagram','social',NULL), (19,'mydealz','referral',NULL),
 (20,'other','x','a_outdoordeals'), (21,'awin','affiliate',NULL), (22,'vaude.com','referral',NULL),
 (23,'criteo','cpm',NULL), (24,'blog','referral',NULL), (25,'taboola','native',NULL),
 (26,'foo','bar',NULL), (27,NULL,'referral',NULL), (28,'(direct)','(none)',NULL),
 (29,NULL,NULL,'only_campaign'))"""

FIXTURE = LOOKUP + """,
ev0 AS (
  SELECT event_id, ts, user_id AS uid, event_type,
         CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS n, epoch_us(ts) AS us
  FROM events),
ev AS (
  SELECT e.*, lk.l_source, lk.l_medium, lk.l_campaign,
         CASE WHEN e.uid % 2 = 0 THEN 'www.shop.de' ELSE 'www.shop.co.uk' END AS host
  FROM ev0 e LEFT JOIN lk ON lk.n = e.n),
ga4 AS (
  SELECT event_id, n,
    CAST(ts AS DATE) AS event_date_dt,
    strftime(ts, '%Y%m%d') AS event_date,
    us AS event_timestamp,
    CASE WHEN event_type IN ('view', 'click') THEN 'page_view' WHEN event_type = 'signup' THEN 'session_start'
         WHEN event_type = 'purchase' THEN 'purchase' ELSE 'user_engagement' END AS event_name,
    CASE WHEN uid % 3 = 0 THEN 'u' || CAST(uid AS VARCHAR) END AS user_id,
    CASE WHEN uid % 50 <> 49 THEN 'p' || CAST(uid AS VARCHAR) END AS user_pseudo_id,
    CAST(CASE WHEN event_id % 97 <> 0 THEN ((us // 1000000 - 21600) // 86400) * 86400 + 21600 END AS BIGINT) AS ga_session_id,
    CASE uid % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS page_device,
    host AS page_hostname,
    CASE event_id % 6 WHEN 0 THEN 'start' WHEN 1 THEN 'productdetail' WHEN 2 THEN 'magazine'
         WHEN 3 THEN 'category' WHEN 4 THEN 'start' END AS page_pagetype,
    CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 11 = 1 THEN 'https://other.example/x?y=1'
         ELSE 'https://' || host || '/p/' || CAST(event_id % 50 AS VARCHAR)
              || CASE WHEN n % 2 = 0 THEN '?q=' || CAST(n AS VARCHAR) || '?z' ELSE '' END END AS page_location,
    CASE WHEN event_id % 13 <> 0 THEN 'Title ' || CAST(event_id % 13 AS VARCHAR) END AS page_title,
    CASE WHEN event_id % 4 = 0 THEN 'https://ref.example/' || CAST(n AS VARCHAR) END AS page_referrer,
    l_source AS source, l_medium AS medium, l_campaign AS campaign,
    CASE WHEN n IN (8, 21, 24) OR n BETWEEN 60 AND 74 THEN 'g' || CAST(event_id % 400 AS VARCHAR) END AS gclid,
    CASE WHEN n BETWEEN 75 AND 79 THEN 'b' || CAST(n AS VARCHAR) END AS session_gadsbraid,
    CASE WHEN n IN (61, 64, 67, 76) THEN CASE event_id % 3 WHEN 0 THEN 'generic_paid_shopping'
         WHEN 1 THEN 'generic_paid_search' ELSE 'brand_paid_search' END END AS session_gadscampaign,
    CAST(CASE WHEN n % 2 = 0 THEN 1 END AS BIGINT) AS session_engaged,
    CAST(CASE WHEN n % 5 = 0 THEN 1 END AS BIGINT) AS entrances,
    CAST(CASE WHEN n <> 0 THEN n * 100 END AS BIGINT) AS engagement_time_msec,
    CAST(uid % 9 AS BIGINT) AS ga_session_number,
    CASE WHEN event_type = 'purchase' THEN '[{"item_id":"i' || CAST(n % 3 AS VARCHAR) || '"}]' ELSE '[]' END AS hashable_items
  FROM ev)"""


def base_ctes(name: str = "base", src: str = "ga4", where: str | None = None) -> str:
    """Model M1 over ``src`` (optionally restricted by ``where``)."""
    w = f"WHERE {where}" if where else ""
    return f"""
{name}_1 AS (
  SELECT *, CASE WHEN user_id IS NOT NULL THEN to_base64(unhex(md5(user_id)))
                 WHEN user_pseudo_id IS NOT NULL THEN to_base64(unhex(md5(user_pseudo_id))) END AS user_key
  FROM {src} {w}),
{name}_2 AS (
  SELECT *, to_base64(unhex(md5(user_key || CAST(ga_session_id AS VARCHAR)))) AS session_key,
    md5(coalesce(CAST(event_timestamp AS VARCHAR), {NM}) || '-' || coalesce(CAST(ga_session_id AS VARCHAR), {NM})
        || '-' || coalesce(event_name, {NM}) || '-' || coalesce(CAST(engagement_time_msec AS VARCHAR), {NM})
        || '-' || coalesce(hashable_items, {NM})) AS sk_id,
    regexp_replace(split_part(page_location, '?', 1), '{SITE_RE}', '') AS page_path,
    regexp_replace(page_location, '{SITE_RE}', '') AS page_path_and_querystring
  FROM {name}_1),
{name} AS (
  SELECT *, row_number() OVER (PARTITION BY session_key ORDER BY event_timestamp, sk_id) AS session_event_number
  FROM {name}_2)"""


def silent_cte(name: str = "silent", base: str = "base", where: str | None = None) -> str:
    """Model M2 (ordered STRING_AGG as the is-null test, as in the original)."""
    w = f"WHERE {where}" if where else ""
    return f"""
{name} AS (
  SELECT min(event_date_dt) AS event_date_dt, session_key, user_key, min(event_timestamp) AS event_timestamp,
    CAST(NULL AS VARCHAR) AS event_name, CAST(NULL AS VARCHAR) AS page_pagetype, ga_session_id AS session_start_time,
    CAST(NULL AS VARCHAR) AS gclid, CAST(NULL AS VARCHAR) AS session_gadscampaign, CAST(NULL AS VARCHAR) AS session_gadsbraid,
    CAST(1 AS BIGINT) AS entrances, CAST(NULL AS VARCHAR) AS page_referrer, CAST(NULL AS VARCHAR) AS page_location,
    CAST(NULL AS VARCHAR) AS source, CAST(NULL AS VARCHAR) AS medium, CAST(NULL AS VARCHAR) AS campaign
  FROM {base} {w}
  GROUP BY session_key, user_key, ga_session_id
  HAVING string_agg(CASE WHEN event_name = 'page_view' THEN event_name END, ',' ORDER BY event_timestamp) IS NULL)"""


def ads_ctes(run: date = RUN) -> str:
    acc = " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(ACCOUNTS))
    return f"""
clicks_raw AS (
  SELECT CASE event_id % 5 {acc} END AS account, event_date_dt AS segments_date,
    CAST(event_id % 5 AS BIGINT) AS customer_id, CAST(event_id % 12 AS BIGINT) AS campaign_id,
    CAST(event_id % 40 AS BIGINT) AS ad_group_id,
    CASE WHEN event_id % 4 = 0 THEN 'SHOPPING' ELSE 'SEARCH' END AS segments_ad_network_type,
    gclid AS click_view_gclid,
    CASE WHEN event_id % 50 = 0 THEN event_date_dt + 1 ELSE event_date_dt END AS _partition_date
  FROM ga4 WHERE gclid IS NOT NULL AND event_id % 2 = 0),
clicks AS (
  SELECT account, segments_date AS date, customer_id AS account_id, campaign_id, ad_group_id AS adgroup_id,
    segments_ad_network_type AS ad_network, click_view_gclid AS gclid,
    md5(coalesce(CAST(customer_id AS VARCHAR), {NM}) || '-' || coalesce(click_view_gclid, {NM})) AS sk_id
  FROM clicks_raw
  WHERE ({last_n('_partition_date', run, 120)}) OR ({prev_year('_partition_date', run, 120)})),
snap_days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events),
snap AS (
  SELECT d, c FROM (SELECT d, unnest(range(0, 12)) AS c FROM snap_days)
  WHERE c <> 9 OR d <= DATE '2024-01-20'),
camp_raw AS (
  SELECT c % 5 AS acc, CAST(c % 5 AS BIGINT) AS customer_id, CAST(c AS BIGINT) AS campaign_id,
    CASE WHEN c = 8 THEN 'x_5_de' WHEN c = 7 AND dayofmonth(d) % 2 = 1 THEN NULL
         ELSE 'x_' || CAST(c % 6 + 1 AS VARCHAR) || '_de' END AS campaign_name, d AS _partition_date
  FROM snap
  UNION ALL
  SELECT 0, CAST(0 AS BIGINT), CAST(3 AS BIGINT), 'x_4_de', d FROM snap WHERE c = 3),
names AS (
  SELECT md5(coalesce(CAST(_partition_date AS VARCHAR), {NM}) || '-' || coalesce(CAST(campaign_id AS VARCHAR), {NM})
             || '-' || coalesce(campaign_name, {NM})) AS sk_id,
    _partition_date AS date, customer_id, campaign_id, campaign_name,
    last_value(campaign_name) OVER (PARTITION BY acc, campaign_id ORDER BY _partition_date) AS campaign_name_last_value
  FROM camp_raw
  WHERE ({last_n('_partition_date', run, 120)}) OR ({prev_year('_partition_date', run, 120)})),
names_nn AS (
  SELECT sk_id, date, customer_id, campaign_id, campaign_name,
    last_value(campaign_name IGNORE NULLS) OVER (PARTITION BY acc, campaign_id ORDER BY date
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS campaign_name_last_value
  FROM (SELECT md5(coalesce(CAST(_partition_date AS VARCHAR), {NM}) || '-' || coalesce(CAST(campaign_id AS VARCHAR), {NM})
             || '-' || coalesce(campaign_name, {NM})) AS sk_id, acc, _partition_date AS date, customer_id, campaign_id,
             campaign_name
        FROM camp_raw
        WHERE ({last_n('_partition_date', run, 120)}) OR ({prev_year('_partition_date', run, 120)}))),
gclid_campaigns AS (
  SELECT k.account, k.date, k.account_id, k.campaign_id, k.adgroup_id, k.gclid,
    coalesce(n.campaign_name, n.campaign_name_last_value) AS campaign_name
  FROM clicks k LEFT JOIN names n ON n.date = k.date AND n.campaign_id = k.campaign_id
  WHERE k.gclid IS NOT NULL)"""


PV_COLS = ("event_date_dt, session_key, user_key, event_timestamp, event_name, page_pagetype, "
           "session_start_time, gclid, session_gadscampaign, session_gadsbraid, entrances, "
           "page_referrer, page_location")


def url_ctes(src: str, name: str) -> str:
    """Url-parameter variant over ``src``: flags, then the page-type proxy."""
    return f"""{name}_1 AS (
  SELECT * EXCLUDE (source, medium),
    if(coalesce((gclid IS NOT NULL OR session_gadsbraid IS NOT NULL) AND (source IS NULL OR source LIKE '%google%'), false),
       'google', source) AS source,
    if(coalesce((gclid IS NOT NULL OR session_gadsbraid IS NOT NULL) AND (source IS NULL OR source LIKE '%google%'), false),
       'cpc', medium) AS medium
  FROM {src}),
{name} AS (
  SELECT {PV_COLS}, source, medium,
    if(coalesce(source = 'google' AND medium = 'cpc', false),
       coalesce(session_gadscampaign,
                CASE page_pagetype WHEN 'start' THEN 'brand_paid_search' WHEN 'productdetail' THEN 'generic_paid_shopping'
                     ELSE if(page_pagetype IS NULL, NULL, 'generic_paid_search') END,
                campaign),
       campaign) AS campaign, sk_id
  FROM {name}_1)"""


def traffic_ctes(run: date = RUN) -> str:
    """M3 (ad-name variant), M4 (url-parameter variant), M3b union + struct."""
    w120 = last_n("event_date_dt", run, 120)
    w30 = last_n("event_date_dt", run, 30)
    return f"""
pv AS (
  SELECT event_date_dt, session_key, user_key, event_timestamp, event_name, page_pagetype,
    ga_session_id AS session_start_time, source, medium, campaign, gclid, session_gadscampaign, session_gadsbraid,
    entrances, page_referrer, page_location, sk_id
  FROM base WHERE event_name = 'page_view' AND {w120}),
gn AS (SELECT DISTINCT gclid, campaign_name AS gads_campaign_name FROM gclid_campaigns WHERE {last_n('date', run, 120)}),
pvj AS (SELECT pv.*, gn.gads_campaign_name FROM pv LEFT JOIN gn USING (gclid)),
adj1 AS (
  SELECT *, coalesce((gclid IS NOT NULL OR session_gadsbraid IS NOT NULL)
                     AND (source IS NULL OR source LIKE '%google%' OR gads_campaign_name IS NOT NULL), false) AS to_cpc
  FROM pvj),
adj2 AS (
  SELECT * EXCLUDE (source, medium),
    if(to_cpc, 'google', source) AS source, if(to_cpc, 'cpc', medium) AS medium
  FROM adj1),
adjusted AS (
  SELECT {PV_COLS}, source, medium,
    if(coalesce(source = 'google' AND medium = 'cpc', false),
       coalesce(gads_campaign_name, session_gadscampaign, if(page_pagetype = 'start', 'brand_paid_search', NULL), campaign),
       campaign) AS campaign, sk_id
  FROM adj2),
pv_all AS (
  SELECT event_date_dt, session_key, user_key, event_timestamp, event_name, page_pagetype,
    ga_session_id AS session_start_time, source, medium, campaign, gclid, session_gadscampaign, session_gadsbraid,
    entrances, page_referrer, page_location, sk_id
  FROM base WHERE {w120}),
{url_ctes("pv", "adjusted_url")},
{url_ctes("pv_all", "adjusted_url_all")},
silent_w AS (SELECT * FROM silent WHERE {w30}),
traffic AS (
  SELECT *, CASE WHEN coalesce(source, medium) IS NOT NULL THEN
      struct_pack(source := source, medium := medium, campaign := campaign, page_pagetype := page_pagetype) END AS tss
  FROM (SELECT * FROM adjusted UNION ALL SELECT *, CAST(NULL AS VARCHAR) AS sk_id FROM silent_w))"""


def session_ctes(run: date = RUN, lookback: int = 7_776_000, traffic: str = "traffic") -> str:
    """M5 first/last, M6 look-back, M7 channel groups, M8 starts, M12 daily."""
    w30 = last_n("event_date_dt", run, 30)
    order = ("event_timestamp, sk_id NULLS FIRST, source NULLS FIRST, medium NULLS FIRST, "
             "campaign NULLS FIRST, page_pagetype NULLS FIRST")
    return f"""
m5 AS (
  SELECT * FROM (
    SELECT event_date_dt, session_key, user_key, session_start_time,
      row_number() OVER w AS event_no,
      first_value(tss) OVER w AS first_value_session,
      last_value(tss IGNORE NULLS) OVER w AS last_non_null_value_session
    FROM {traffic}
    WINDOW w AS (PARTITION BY session_key ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
  WHERE event_no = 1),
m6 AS (
  -- the user's latest non-NULL session source that started 1 s .. {lookback} s earlier
  SELECT a.event_date_dt, a.user_key, a.session_key, a.session_start_time,
    coalesce(a.first_value_session,
      (SELECT arg_max(b.last_non_null_value_session, b.session_start_time) FROM m5 b
        WHERE b.user_key IS NOT DISTINCT FROM a.user_key AND b.last_non_null_value_session IS NOT NULL
          AND b.session_start_time BETWEEN a.session_start_time - {lookback} AND a.session_start_time - 1))
      AS last_non_direct_source_user
  FROM m5 a),
m7j AS (
  SELECT * FROM (SELECT event_date_dt, session_key, user_key, session_start_time, first_value_session FROM m5 WHERE {w30})
  LEFT JOIN (SELECT event_date_dt, session_key, user_key, session_start_time, last_non_direct_source_user FROM m6 WHERE {w30})
  USING (event_date_dt, session_key, user_key, session_start_time)),
m7s AS (
  SELECT *,
    CASE WHEN first_value_session IS NOT NULL THEN first_value_session.source
         WHEN last_non_direct_source_user IS NOT NULL THEN last_non_direct_source_user.source END AS session_source,
    CASE WHEN first_value_session IS NOT NULL THEN first_value_session.medium
         WHEN last_non_direct_source_user IS NOT NULL THEN last_non_direct_source_user.medium END AS session_medium,
    CASE WHEN first_value_session IS NOT NULL THEN first_value_session.campaign
         WHEN last_non_direct_source_user IS NOT NULL THEN last_non_direct_source_user.campaign END AS session_campaign,
    CASE WHEN first_value_session IS NOT NULL THEN first_value_session.page_pagetype
         WHEN last_non_direct_source_user IS NOT NULL THEN last_non_direct_source_user.page_pagetype END AS session_page_pagetype
  FROM m7j),
m7 AS (
  SELECT *, {custom_case('session_source', 'session_medium', 'session_campaign', 'session_page_pagetype')} AS session_channel_group
  FROM m7s),
m8 AS (
  SELECT * FROM (
    SELECT event_date_dt, event_timestamp, event_name, ga_session_id, page_location, page_path,
      page_path_and_querystring, ga_session_number, session_engaged, engagement_time_msec, page_title,
      page_referrer, page_device, page_hostname, user_key, session_key, sk_id
    FROM base WHERE event_name = 'session_start' AND {w30})
  LEFT JOIN (SELECT session_key, session_source, session_medium, session_campaign, session_channel_group FROM m7 WHERE {w30})
  USING (session_key)),
m12 AS (
  SELECT event_date_dt, page_device, page_hostname, session_channel_group, session_source, session_medium,
    session_campaign, count(event_name) AS ga4_sessions
  FROM m8 GROUP BY event_date_dt, page_device, page_hostname, session_channel_group, session_source,
    session_medium, session_campaign)"""


# --- fixed values: labels, patterns and order of the rules -------
SEARCH = ("suche.t-online.|qwant.|suche.web.|search.yahoo.|baidu.|suche.gmx.|suche.1und1.|suche.aol.|"
          "google.com / referral|startpage.com|search.brave.|yandex.")
MANUF = ("manuf|edelrid|redchiliclimbing.com|sn-supernatural.com|komperdell.com|vaude.com|trollkids.com|"
         "houdinisportswear.com|locator.suunto.com|martini-sportswear.com|mountain-equipment.de|maier-sports.com|"
         "gonso.de|brandwidgets.outtra.com|chillaz.com|alpina-sports.com")


def custom_case(s: str, m: str, c: str, p: str) -> str:
    """Custom rule set."""
    return f"""CASE
  WHEN {s} = 'google' AND {m} = 'cpc' AND (regexp_matches({c}, '_2_|_3_') OR {c} = 'generic_paid_search') THEN 'Generic Paid Search Google'
  WHEN {s} = 'google' AND {m} = 'cpc' AND (regexp_matches({c}, '_4_|_6_') OR {c} IN ('generic_paid_shopping', 'generic_paid_pmax')) THEN 'Generic Paid Shopping Google'
  WHEN {s} = 'bing' AND {m} = 'cpc' AND NOT regexp_matches({c}, '_5_|_1_') THEN 'Generic Paid Search Bing'
  WHEN {s} IN ('google', 'bing') AND {m} = 'cpc' AND (regexp_matches({c}, '_1_') OR {c} = 'brand_paid_search') THEN 'Brand Paid Search'
  WHEN (regexp_matches({s}, '{SEARCH}') OR {m} = 'organic') AND {p} = 'start' THEN 'Organic Search Home'
  WHEN (regexp_matches({s}, '{SEARCH}') OR {m} = 'organic' OR {c} = 'google_shopping_organic') AND ({p} NOT IN ('start', 'magazine') OR {p} IS NULL) THEN 'Organic Search Non-Home'
  WHEN (regexp_matches({s}, '{SEARCH}') OR {m} = 'organic') AND {p} = 'magazine' THEN 'Organic Search Magazin'
  WHEN regexp_matches({s}, 'newsletter|Newsletter|postwurfsendung') OR regexp_matches({c}, 'y??_kw??_??_ns_') THEN 'Newsletter'
  WHEN regexp_matches({s}, 'parcellab') OR regexp_matches({m}, 'parcellab') THEN 'Triggermail Parcellab'
  WHEN {s} = 'triggermail' AND {m} = 'email' THEN 'Triggermail CRM'
  WHEN regexp_matches({s}, 'facebook|instagram|pinterest|youtube') AND {m} = 'cpc' THEN 'Social Paid'
  WHEN regexp_matches({s}, 'facebook|instagram|pinterest|youtube|strava|linkedin|IGShopping') AND {m} IN ('social', 'referral', 'Social') THEN 'Social Organic'
  WHEN regexp_matches({s}, 'psm|mydealz|beslist|trovaprezzi|shoptail|kelkoo') OR {c} LIKE '%_outdoordeals' THEN 'PSM'
  WHEN regexp_matches({s}, 'affiliate|awin|redbrain|ulligunde|bike-magazin|outdoor-professionell') THEN 'Affiliate'
  WHEN regexp_matches({s}, '{MANUF}') THEN 'Hersteller Links'
  WHEN regexp_matches({s}, 'criteo') OR {s} = 'bsmart' OR regexp_matches({c}, '_5_') OR ({s} = 'google' AND {m} = 'cpc' AND {c} = 'display') THEN 'Display'
  WHEN {m} = 'referral' THEN 'Referral'
  WHEN {s} IN ('taboola', 'outbrain', 'partner') OR {m} = 'cpm' OR {c} = '_branding_' THEN 'Branding'
  WHEN {s} IS NULL AND {m} IS NULL THEN 'Direct'
  ELSE 'Unassigned' END"""


def default_case(s: str, m: str, k: str) -> str:
    """Default rule set."""
    return f"""CASE
  WHEN {s} IS NULL AND {m} IS NULL THEN 'Direct'
  WHEN {s} = '(direct)' AND {m} IN ('(none)', '(not set)') THEN 'Direct'
  WHEN regexp_matches({s}, '^(facebook|instagram|pinterest|reddit|twitter|linkedin)') AND regexp_matches({m}, '^(cpc|ppc|paid)') THEN 'Paid Social'
  WHEN regexp_matches({s}, '^(facebook|instagram|pinterest|reddit|twitter|linkedin)')
    OR regexp_matches({m}, '^(social|social-network|social-media|sm|social network|social media)') OR {k} = 'SOURCE_CATEGORY_SOCIAL' THEN 'Organic Social'
  WHEN regexp_matches({m}, 'email|e-mail|e_mail|e mail') OR regexp_matches({s}, 'email|e-mail|e_mail|e mail') THEN 'Email'
  WHEN regexp_matches({m}, 'affiliate|affiliates') THEN 'Affiliates'
  WHEN {k} = 'SOURCE_CATEGORY_SHOPPING' AND regexp_matches({m}, '^(.*cp.*|ppc|paid.*)$') THEN 'Paid Shopping'
  WHEN ({k} = 'SOURCE_CATEGORY_VIDEO' AND regexp_matches({m}, '^(.*cp.*|ppc|paid.*)$')) OR {s} = 'dv360_video' THEN 'Paid Video'
  WHEN regexp_matches({m}, '^(display|cpm|banner)$') OR {s} = 'dv360_display' THEN 'Display'
  WHEN regexp_matches({m}, '^(cpc|ppc|paidsearch)$') THEN 'Paid Search'
  WHEN regexp_matches({m}, '^(cpv|cpa|cpp|content-text)$') THEN 'Other Advertising'
  WHEN {m} = 'organic' OR {k} = 'SOURCE_CATEGORY_SEARCH' THEN 'Organic Search'
  WHEN regexp_matches({m}, '^(.*video.*)$') OR {k} = 'SOURCE_CATEGORY_VIDEO' THEN 'Organic Video'
  WHEN {k} = 'SOURCE_CATEGORY_SHOPPING' THEN 'Organic Shopping'
  WHEN {m} = 'referral' THEN 'Referral'
  WHEN {m} = 'audio' THEN 'Audio'
  WHEN {m} = 'sms' THEN 'SMS'
  WHEN regexp_matches({m}, '(mobile|notification|push$)') OR {s} = 'firebase' THEN 'Push Notifications'
  ELSE '(Other)' END"""


def chain(run: date = RUN, lookback: int = 7_776_000) -> str:
    """Every CTE of the full chain (DuckDB skips the unused ones)."""
    return ("WITH " + FIXTURE + "," + base_ctes("base", "ga4", last_n("event_date_dt", run, 120)) + ","
            + silent_cte("silent", "base", last_n("event_date_dt", run, 30)) + "," + ads_ctes(run) + ","
            + traffic_ctes(run) + "," + session_ctes(run, lookback))


def with_chain(final: str, run: date = RUN, lookback: int = 7_776_000, extra: str = "") -> str:
    return chain(run, lookback) + (("," + extra) if extra else "") + "\n" + final
