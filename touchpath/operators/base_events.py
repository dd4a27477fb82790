"""Base events: parameters, user/session keys, event number, surrogate key, page paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.config import RunConfig
from touchpath.functions import keys as K
from touchpath.functions.params import INT, STRING, engaged_flag, event_param
from touchpath.functions.paths import page_path, page_path_and_querystring
from touchpath.operators.skew import number_within
from touchpath.sources.sampling import dev_sample

BASE_COLUMNS = [
    "event_date_dt", "event_timestamp", "event_name", "event_params", "user_id", "user_pseudo_id",
    "device", "page_device", "page_hostname", "stream_id", "items", "ecommerce", "ga_session_id",
    "page_location", "ga_session_number", "session_engaged", "engagement_time_msec", "page_title",
    "page_pagetype", "page_referrer", "user_key", "session_key", "session_event_number", "sk_id",
    "page_path", "page_path_and_querystring",
]


# traffic parameters read by the page-view models; extracted in the scan-level
# projection so the export's parameter array is never carried whole
TRAFFIC_PARAMS = {"source": STRING, "medium": STRING, "campaign": STRING, "gclid": STRING,
                  "session_gadscampaign": STRING, "session_gadsbraid": STRING, "entrances": INT}


def select_source(raw: DataFrame, cfg: RunConfig, traffic: bool = False) -> DataFrame:
    """Date-pruned projection of the raw export with the needed parameters."""
    cond = cfg.window("base_events", F.col("shard_date"))
    src = raw if cond is None else raw.where(cond)
    src = dev_sample(src, cfg)      # dev runs read a seeded sample of the export
    return src.select(
        *(["shard_date"] if "shard_date" in src.columns else []),
        F.to_date("event_date", "yyyyMMdd").alias("event_date_dt"),
        "event_timestamp", "event_name", "event_params", "user_id", "user_pseudo_id", "device",
        F.col("device.category").alias("page_device"),
        F.col("device.web_info.hostname").alias("page_hostname"),
        "stream_id", "items", "ecommerce",
        event_param("ga_session_id", INT).alias("ga_session_id"),
        event_param("page_location").alias("page_location"),
        event_param("ga_session_number", INT).alias("ga_session_number"),
        engaged_flag().cast("bigint").alias("session_engaged"),
        event_param("engagement_time_msec", INT).alias("engagement_time_msec"),
        event_param("page_title").alias("page_title"),
        event_param("page_pagetype").alias("page_pagetype"),
        event_param("page_referrer").alias("page_referrer"),
        *([event_param(k, t).alias(k) for k, t in TRAFFIC_PARAMS.items()] if traffic else []),
    )


def with_identity_keys(df: DataFrame) -> DataFrame:
    """user_key (user id, else pseudo id, else NULL) and session_key."""
    ukey = K.user_key(F.col("user_id"), F.col("user_pseudo_id"))
    return (df.withColumn("user_key", ukey)
              .withColumn("session_key", K.session_key(F.col("user_key"), F.col("ga_session_id"))))


def event_surrogate_key():
    return K.surrogate_key(F.col("event_timestamp"), F.col("ga_session_id"), F.col("event_name"),
                           F.col("engagement_time_msec"), K.items_json(F.col("items")))


def keyed_events(raw: DataFrame, cfg: RunConfig) -> DataFrame:
    """Model M1 without the event number: what the downstream models read.

    Leaving the number out keeps its shuffle, count table and join out of
    every downstream plan (Catalyst can prune the window but not the join).
    """
    df = with_identity_keys(select_source(raw, cfg, traffic=True)).withColumn("sk_id", event_surrogate_key())
    return (df.withColumn("page_path", page_path(F.col("page_location"), cfg.site))
              .withColumn("page_path_and_querystring", page_path_and_querystring(F.col("page_location"), cfg.site)))


def base_events(raw: DataFrame | None, cfg: RunConfig, numbering: str = "bucketed", keyed: DataFrame | None = None,
                with_shard: bool = False) -> DataFrame:
    """Model M1.  ``numbering='bucketed'`` is the skew-proof event number, which
    reads its input twice (rows and counts): ``keyed`` gives the stored keyed
    events, so that the export itself is read once.  ``'window'`` is the plain
    per-session window (one task per session).  ``with_shard`` keeps the shard
    date, by which a stored table is partitioned."""
    df = keyed_events(raw, cfg) if keyed is None else keyed
    order = ["event_timestamp", "sk_id"]
    if numbering == "bucketed":
        df = number_within(df, "session_key", order, cfg.numbering_bucket_us, "session_event_number")
    elif numbering == "window":
        from pyspark.sql import Window
        df = df.withColumn("session_event_number", F.row_number().over(
            Window.partitionBy("session_key").orderBy(*order)).cast("long"))
    else:
        raise ValueError(numbering)
    return df.select(*BASE_COLUMNS, *(["shard_date"] if with_shard else []))
