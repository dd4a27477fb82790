"""Reports on top of the session chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAILY_DIMENSIONS = ["event_date_dt", "page_device", "page_hostname", "session_channel_group",
                    "session_source", "session_medium", "session_campaign"]


def daily_sessions(session_starts: DataFrame) -> DataFrame:
    """Model M12: sessions per day and 7 dimensions (non-NULL event names)."""
    return (session_starts.groupBy(*DAILY_DIMENSIONS)
            .agg(F.count("event_name").alias("ga4_sessions")))


def sessions_per_channel(channel_groups: DataFrame) -> DataFrame:
    """Sessions per channel group (the flagship summary)."""
    return (channel_groups.groupBy("session_channel_group")
            .agg(F.count(F.lit(1)).alias("sessions")))
