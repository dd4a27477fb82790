"""Session attribution chain: silent sessions, traffic repair, first/last
source, user look-back, channel groups, enriched session starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchpath.config import RunConfig, apply_window
from touchpath.functions.dates import last_n_days
from touchpath.functions.channels import custom_channel_group
from touchpath.functions.params import INT, STRING, event_param
from touchpath.functions.traffic import preferred_field, traffic_struct
from touchpath.operators.asof import last_before
from touchpath.operators.skew import left_join_known, left_join_nonnull

TRAFFIC_EVENT_COLUMNS = [
    "event_date_dt", "session_key", "user_key", "event_timestamp", "event_name", "page_pagetype",
    "session_start_time", "gclid", "session_gadscampaign", "session_gadsbraid", "entrances",
    "page_referrer", "page_location", "source", "medium", "campaign",
]
# what the page-view and silent-session models read of the keyed events
TRAFFIC_INPUT = [
    "event_date_dt", "event_timestamp", "event_name", "ga_session_id", "user_key", "session_key", "sk_id", "page_pagetype",
    "page_referrer", "page_location", "source", "medium", "campaign", "gclid", "session_gadscampaign", "session_gadsbraid", "entrances",
]
# hidden tie-break key carried with traffic events (NULL for silent sessions)
TIE_KEY = "sk_id"


# --------------------------------------------------------------------------- M2
def page_view_counts(base: DataFrame, cfg: RunConfig) -> DataFrame:
    """Per (session_key, user_key, session_start_time): first date, first
    event time and the number of page views.  Partial aggregation keeps a hot
    key from being collected in one task."""
    b = apply_window(base, cfg, "non_pageview_sessions")
    return (b.groupBy("session_key", "user_key", F.col("ga_session_id").alias("session_start_time"))
             .agg(F.min("event_date_dt").alias("event_date_dt"),
                  F.min("event_timestamp").alias("event_timestamp"),
                  F.count_if(F.col("event_name") == F.lit("page_view")).alias("n_page_views")))


def page_view_string(n: Column, sep: str = ",") -> Column:
    """The ordered string aggregate of the page-view marker, from its count.

    Every aggregated value is the same literal 'page_view', so the ordered
    concatenation is fixed by the count alone; NULL when there is none.
    """
    return F.when(n > 0, F.concat(F.repeat(F.lit("page_view" + sep), (n - 1).cast("int")), F.lit("page_view")))


def ordered_string_agg(df: DataFrame, keys: list[str], text: str, order: list[str], out: str, sep: str = ",",
                       width: int = 3_600_000_000) -> DataFrame:
    """One row per ``keys`` with the non-NULL ``text`` values joined in the order of
    the columns ``order`` (NULLs first); NULL where there is none.

    ``listagg`` sorts a group in one task, so it runs per bucket of ``width`` units
    of the first order column, and then joins the buckets' lists: of a hot key, a
    task sorts one bucket, and the last step meets one list per bucket.  ``listagg``
    skips NULLs and is NULL of none, so rows without ``text`` stay for their keys.
    """
    quoted = lambda c: f"`{c}`"
    joined = lambda c, by: F.expr(f"listagg({quoted(c)}, {sep!r}) WITHIN GROUP (ORDER BY {by})")
    by = ", ".join(f"{quoted(c)} ASC NULLS FIRST" for c in order)
    cut = df.withColumn("__bucket", F.floor(F.col(order[0]) / F.lit(width)))
    lists = cut.groupBy(*keys, "__bucket").agg(joined(text, by).alias("__list"))
    return lists.groupBy(*keys).agg(joined("__list", "`__bucket` ASC NULLS FIRST").alias(out))


def non_pageview_sessions(base: DataFrame, cfg: RunConfig) -> DataFrame:
    """Model M2: sessions without any page view, shaped like traffic events."""
    g = page_view_counts(base, cfg).where(F.col("n_page_views") == 0)
    s = F.lit(None).cast("string")
    return g.select(
        "event_date_dt", "session_key", "user_key", "event_timestamp",
        s.alias("event_name"), s.alias("page_pagetype"), "session_start_time",
        s.alias("gclid"), s.alias("session_gadscampaign"), s.alias("session_gadsbraid"),
        F.lit(1).cast("bigint").alias("entrances"), s.alias("page_referrer"), s.alias("page_location"),
        s.alias("source"), s.alias("medium"), s.alias("campaign"))


# --------------------------------------------------------------------- M3 / M4
def traffic_params(base: DataFrame, cfg: RunConfig, pageviews_only: bool = True) -> DataFrame:
    """Page-view events with their traffic parameters."""
    b = base.where(F.col("event_name") == F.lit("page_view")) if pageviews_only else base
    b = apply_window(b, cfg, "pageviews")
    # keyed events carry the parameters already; a stored base-events table
    # only has the array
    param = lambda k, t=STRING: (F.col(k) if k in b.columns else event_param(k, t)).alias(k)
    return b.select(
        "event_date_dt", "session_key", "user_key", "event_timestamp", "event_name", "page_pagetype",
        F.col("ga_session_id").alias("session_start_time"),
        param("source"), param("medium"), param("campaign"), param("gclid"),
        param("session_gadscampaign"), param("session_gadsbraid"), param("entrances", INT),
        "page_referrer", "page_location", TIE_KEY)


def _has_click_id() -> Column:
    return F.col("gclid").isNotNull() | F.col("session_gadsbraid").isNotNull()


def _is_google_cpc() -> Column:
    return (F.col("source") == F.lit("google")) & (F.col("medium") == F.lit("cpc"))


def _reassign_google_cpc(df: DataFrame, extra: Column | None = None) -> DataFrame:
    """With a click id, an empty or 'google' source (or a matched ad name)
    becomes google / cpc."""
    own = F.col("source").isNull() | F.col("source").like("%google%")
    if extra is not None:
        own = own | extra
    cond = _has_click_id() & own
    return df.select(*[c for c in df.columns if c not in ("source", "medium")],
                     F.when(cond, F.lit("google")).otherwise(F.col("source")).alias("source"),
                     F.when(cond, F.lit("cpc")).otherwise(F.col("medium")).alias("medium"))


def gclid_name_table(gclid_campaigns: DataFrame, cfg: RunConfig) -> DataFrame:
    """DISTINCT (gclid, campaign name) over the click-date window.

    An incremental run only sees clicks from the high-water mark on;
    ``cfg.click_lookback_days`` widens that to older clicks.
    """
    widen = cfg.click_lookback_days if cfg.mode == "incremental" else 0
    g = apply_window(gclid_campaigns, cfg, "gclid_names", col="date", widen_days=widen)
    return g.select("gclid", F.col("campaign_name").alias("gads_campaign_name")).distinct()


def join_gclid_names(pv: DataFrame, names: DataFrame, stored: bool = False) -> DataFrame:
    """page views LEFT JOIN names USING (gclid).  Most page views carry no known
    gclid: of a ``stored`` table, which may be read twice, they are not shuffled.
    A gclid with several names multiplies its page views (kept, as in the original)."""
    join = left_join_known if stored else left_join_nonnull
    return join(pv, names, ["gclid"], ["gads_campaign_name"])


def adjust_google_params(base: DataFrame, gclid_campaigns: DataFrame, cfg: RunConfig, stored: bool = False) -> DataFrame:
    """Model M3 (ad-name variant): repair source/medium/campaign of ad clicks.
    ``stored``: ``base`` is a table, not a scan of the export."""
    pv = traffic_params(base, cfg, pageviews_only=True)
    j = join_gclid_names(pv, gclid_name_table(gclid_campaigns, cfg), stored)
    j = _reassign_google_cpc(j, F.col("gads_campaign_name").isNotNull())
    # google / cpc traffic: ad name, else the url parameter, else a start page
    # means a brand campaign, else the campaign as sent
    proxy = F.when(F.col("page_pagetype") == F.lit("start"), F.lit("brand_paid_search"))
    fixed = F.coalesce(F.col("gads_campaign_name"), F.col("session_gadscampaign"), proxy, F.col("campaign"))
    campaign = F.when(_is_google_cpc(), fixed).otherwise(F.col("campaign"))
    return j.withColumn("campaign", campaign).select(*TRAFFIC_EVENT_COLUMNS, TIE_KEY)


def adjust_google_params_urlparam(base: DataFrame, cfg: RunConfig,
                                  pageviews_only: bool | None = None) -> DataFrame:
    """Model M4 (url-parameter variant, no ad data): campaign from the url
    parameter, else a proxy from the landing page type."""
    po = cfg.pageviews_only if pageviews_only is None else pageviews_only
    j = _reassign_google_cpc(traffic_params(base, cfg, pageviews_only=po))
    # google / cpc traffic: the url parameter, else a proxy from the landing
    # page type (start = brand, product page = shopping, any other known type =
    # generic search), else the campaign as sent
    pt = F.col("page_pagetype")
    proxy = (F.when(pt == F.lit("start"), F.lit("brand_paid_search"))
              .when(pt == F.lit("productdetail"), F.lit("generic_paid_shopping"))
              .when(pt.isNotNull(), F.lit("generic_paid_search")))
    fixed = F.coalesce(F.col("session_gadscampaign"), proxy, F.col("campaign"))
    campaign = F.when(_is_google_cpc(), fixed).otherwise(F.col("campaign"))
    return j.withColumn("campaign", campaign).select(*TRAFFIC_EVENT_COLUMNS, TIE_KEY)


def with_silent_sessions(adjusted: DataFrame, silent: DataFrame, cfg: RunConfig) -> DataFrame:
    """UNION ALL of repaired page views and page-view-less sessions, plus the
    traffic struct (NULL = direct)."""
    s = apply_window(silent, cfg, "silent_sessions").select(
        *TRAFFIC_EVENT_COLUMNS, F.lit(None).cast("string").alias(TIE_KEY))
    u = adjusted.select(*TRAFFIC_EVENT_COLUMNS, TIE_KEY).unionByName(s)
    return u.withColumn("traffic_source_struct", traffic_struct())


# --------------------------------------------------------------------------- M5
def _event_order() -> Column:
    # D7: event time, then the event key, then the traffic values (NULL first)
    return F.struct("event_timestamp", TIE_KEY, "source", "medium", "campaign", "page_pagetype")


def source_states(events: DataFrame, *by: str) -> DataFrame:
    """The mergeable state of first and last source per ``by`` (session_key and
    whatever else): ``first`` is the least event by :func:`_event_order` with what
    M5 reports of it, ``last`` the greatest event with a source.  The order stands
    in front of each struct, so states merge by minimum and maximum."""
    ts = F.col("traffic_source_struct")
    first = F.struct(_event_order().alias("at"), "event_date_dt", "user_key", "session_start_time", ts.alias("t"))
    last = F.when(ts.isNotNull(), F.struct(_event_order().alias("at"), ts.alias("t")))
    return events.groupBy(*by).agg(F.min(first).alias("first"), F.max(last).alias("last"))


def merged_states(states: DataFrame, *by: str) -> DataFrame:
    """One state per ``by`` of any number of partial ones."""
    return states.groupBy(*by).agg(F.min("first").alias("first"), F.max("last").alias("last"))


def first_last_of(states: DataFrame, *carried: str) -> DataFrame:
    """Model M5's row of each state, and the columns ``carried`` along."""
    return states.select(F.col("first.event_date_dt").alias("event_date_dt"), "session_key",
                         F.col("first.user_key").alias("user_key"),
                         F.col("first.session_start_time").alias("session_start_time"),
                         F.lit(1).cast("bigint").alias("event_no"),
                         F.col("first.t").alias("first_value_session"),
                         F.col("last.t").alias("last_non_null_value_session"), *carried)


def session_first_last_source(events: DataFrame, cfg: RunConfig) -> DataFrame:
    """Model M5: one row per session_key with the first traffic struct
    (respecting NULL) and the last non-NULL one.

    Written as an aggregate (a minimum and a maximum of structs) instead of a
    full-frame window + ``row_number() = 1``: partial aggregation combines a
    hot or NULL session key map-side, and no window buffers a whole session.
    All events with a NULL session key fold into one row, as in the original;
    ``cfg.drop_null_keys`` drops them instead.  The original rebuilds this
    over all history every run; ``streaming.session_state`` keeps the states and
    merges new days into them.
    """
    e = apply_window(events, cfg, "session_first_last_source")
    if cfg.drop_null_keys:
        e = e.where(F.col("session_key").isNotNull())
    return first_last_of(source_states(e, "session_key"))


# --------------------------------------------------------------------------- M6
def _lookback_simple(s: DataFrame, lookback: int) -> Column:
    w = (Window.partitionBy("user_key").orderBy("session_start_time")
         .rangeBetween(-lookback, -1))
    v = F.col("last_non_null_value_session")
    return F.max_by(v, F.when(v.isNotNull(), F.struct("session_start_time", "session_key"))).over(w)


def session_last_user_source(first_last: DataFrame, cfg: RunConfig,
                             lookback_seconds: int | None = None,
                             strategy: str = "asof", keep_first: bool = False) -> DataFrame:
    """Model M6: the session's own first source, else the user's last
    non-NULL source of sessions that started 1 s .. ``lookback`` s earlier.

    ``strategy='asof'`` deals the sessions once, by ranges of (user, start), and
    carries the last source along (one user may fill any number of ranges);
    ``'window'`` is the plain sliding window per user.

    The current session's own later source is never used.  A session without a
    start time gets no look-back.
    """
    L = cfg.lookback_seconds if lookback_seconds is None else lookback_seconds
    s = apply_window(first_last, cfg, "session_last_user_source")
    if cfg.first_last_days is not None and cfg.mode != "dev":
        # channel groups of the last 30 days need the sessions of those and of
        # the look-back before them (the bound is checked by the config); the
        # first/last table itself keeps its whole history
        s = s.where(last_n_days(F.col("event_date_dt"), cfg.run_date, cfg.first_last_days) | F.col("event_date_dt").isNull())
    if strategy == "asof":
        s = s.select("event_date_dt", "user_key", "session_key", "session_start_time", "first_value_session", "last_non_null_value_session")
        s = last_before(s, "user_key", "session_start_time", "session_key", "last_non_null_value_session", "__lookback", L)
    elif strategy == "window":
        s = s.withColumn("__lookback", F.when(F.col("session_start_time").isNotNull(), _lookback_simple(s, L)))
    else:
        raise ValueError(strategy)
    cols = ["event_date_dt", "user_key", "session_key", "session_start_time",
            F.coalesce(F.col("first_value_session"), F.col("__lookback")).alias("last_non_direct_source_user")]
    if keep_first:
        cols.append("first_value_session")
    return s.select(*cols)


# --------------------------------------------------------------------------- M7
SESSION_KEYS = ["event_date_dt", "session_key", "user_key", "session_start_time"]


def session_channel_groups(first_last: DataFrame, cfg: RunConfig, lookback_seconds: int | None = None,
                           strategy: str = "asof") -> DataFrame:
    """Model M7: session source by precedence session -> user -> NULL, then
    the custom channel-group rules.

    The look-back row of a session is derived from the same first/last row,
    so instead of joining the two back together on four keys the first value
    is carried along; the join's semantics are kept: a NULL key never matches,
    so such a session gets no look-back value.
    """
    m6 = session_last_user_source(first_last, cfg, lookback_seconds, strategy, keep_first=True)
    m6 = apply_window(m6, cfg, "session_channel_groups")
    keys_ok = F.col("session_key").isNotNull() & F.col("user_key").isNotNull() \
        & F.col("session_start_time").isNotNull() & F.col("event_date_dt").isNotNull()
    first, last = F.col("first_value_session"), F.col("last_non_direct_source_user")
    df = m6.select(*SESSION_KEYS, "first_value_session",
                   F.when(keys_ok, last).alias("last_non_direct_source_user"))
    for f, out in (("source", "session_source"), ("medium", "session_medium"),
                   ("campaign", "session_campaign"), ("page_pagetype", "session_page_pagetype")):
        df = df.withColumn(out, preferred_field(first, last, f))
    return df.withColumn("session_channel_group", custom_channel_group(
        F.col("session_source"), F.col("session_medium"), F.col("session_campaign"),
        F.col("session_page_pagetype")))


# --------------------------------------------------------------------------- M8
SESSION_START_COLUMNS = [
    "event_date_dt", "event_timestamp", "event_name", "event_params", "ga_session_id", "page_location",
    "page_path", "page_path_and_querystring", "ga_session_number", "session_engaged",
    "engagement_time_msec", "page_title", "page_referrer", "page_device", "page_hostname",
    "user_key", "session_key", "sk_id",
]


def session_starts_enriched(base: DataFrame, channel_groups: DataFrame, cfg: RunConfig) -> DataFrame:
    """Model M8: session_start events LEFT JOIN session channel groups USING (session_key).

    Both sides are cut to the same date window, so a session_start inside the
    window whose session began before it finds no group;
    ``cfg.widen_sessions_days`` reaches that much further back on the group side.
    """
    starts = apply_window(base.where(F.col("event_name") == F.lit("session_start")), cfg, "session_starts")
    starts = starts.select(*SESSION_START_COLUMNS)
    groups = apply_window(channel_groups, cfg, "session_starts", widen_days=cfg.widen_sessions_days).select(
        "session_key", "session_source", "session_medium", "session_campaign", "session_channel_group")
    return left_join_nonnull(starts, groups, ["session_key"],
                             ["session_source", "session_medium", "session_campaign", "session_channel_group"])
