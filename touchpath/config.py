"""Run configuration and the per-model date predicate (run-mode switch).

Every model reads a date window that depends on the run mode:

* ``full``        – the last *n* days before ``run_date`` (n differs per model),
* ``incremental`` – a fixed list of partitions (late-data reload) or the range
                    from the target's high-water mark up to yesterday,
* ``dev``         – the last two days (one for click stats).

``run_date`` replaces ``current_date()`` so a replay is deterministic.  Dates
are turned into literals on the driver, so Parquet partition pruning sees
constants.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import Column

from touchpath.functions import dates as D

FULL, INCREMENTAL, DEV = "full", "incremental", "dev"

# Per-model windows: (full-refresh days, dev days, incremental kind).
# kind "partitions" = replace the fixed days run_date-1 and run_date-2,
# kind "hwm" = from the high-water mark up to yesterday, None = always full.
MODEL_WINDOWS = {
    "base_events": (120, 2, "partitions"),
    "non_pageview_sessions": (30, 2, "hwm"),
    "pageviews": (120, 2, "hwm"),
    "silent_sessions": (30, 2, "hwm"),
    "gclid_names": (120, 2, "hwm"),
    "session_first_last_source": (None, 2, None),
    "session_last_user_source": (None, 2, None),
    "session_channel_groups": (30, 2, "hwm"),
    "session_starts": (30, 2, "hwm"),
}


@dataclass(frozen=True)
class RunConfig:
    run_date: date
    mode: str = FULL
    # high-water marks (max partition of each incremental target), by model
    high_water_marks: dict = field(default_factory=dict)
    lookback_seconds: int = 7_776_000          # 90 days
    numbering_bucket_us: int = 3_600_000_000    # skew split of event numbering
    site: str = "shop"                          # own site name for page paths
    pageviews_only: bool = True                 # url-param variant: page views only
    click_lookback_days: int = 0                # incremental: also match clicks this much older
    widen_sessions_days: int = 0                # session starts: channel groups this much older
    drop_null_keys: bool = False                # first/last: drop the folded NULL session
    first_last_days: int | None = None          # look-back: sessions read (None = all)
    dev_sample_percent: float = 5.0
    dev_sampling: str = "events"                # dev: events by hash, or whole "blocks" at the reader
    sample_seed: int = 42
    reload_days: int = 2                        # partitions replaced incrementally

    def __post_init__(self):
        if self.mode not in (FULL, INCREMENTAL, DEV):
            raise ValueError(f"mode must be one of full, incremental, dev (got {self.mode!r})")
        if self.lookback_seconds < 1 or self.numbering_bucket_us < 1:
            raise ValueError("look-back and bucket widths must be positive")
        if self.dev_sampling not in ("events", "blocks"):
            raise ValueError(f"dev_sampling must be events or blocks (got {self.dev_sampling!r})")
        if self.reload_days < 1:
            raise ValueError("at least one day is reloaded")
        if self.first_last_days is not None and self.first_last_days < self.least_first_last_days:
            raise ValueError(f"first_last_days={self.first_last_days} would cut sessions that the channel groups of the "
                             f"last 30 days need: at least {self.least_first_last_days}")

    @property
    def least_first_last_days(self) -> int:
        """Days of sessions behind the channel groups of a run: their 30-day
        window, the look-back and two days of slack."""
        return 30 + -(-self.lookback_seconds // 86_400) + 2

    def with_(self, **kw) -> "RunConfig":
        return replace(self, **kw)

    @property
    def yesterday(self) -> date:
        return self.run_date - timedelta(days=1)

    def reload_partitions(self, n: int | None = None) -> list[date]:
        n = self.reload_days if n is None else n
        return [self.run_date - timedelta(days=i) for i in range(1, n + 1)]

    def hwm(self, model: str) -> date:
        if model not in self.high_water_marks:
            raise KeyError(f"incremental run needs a high-water mark for {model!r}")
        return self.high_water_marks[model]

    def window(self, model: str, col: Column, widen_days: int = 0) -> Column | None:
        """Date predicate of ``model`` on ``col``; ``None`` = read everything.

        ``widen_days`` moves the lower bound of a range window earlier.
        """
        full_days, dev_days, kind = MODEL_WINDOWS[model]
        if self.mode == DEV:
            return D.last_n_days(col, self.run_date, dev_days + widen_days)
        if self.mode == INCREMENTAL and kind == "partitions":
            return D.in_dates(col, self.reload_partitions())
        if self.mode == INCREMENTAL and kind == "hwm":
            return D.incremental_range(col, self.hwm(model) - timedelta(days=widen_days), self.run_date)
        if full_days is None:
            return None
        return D.last_n_days(col, self.run_date, full_days + widen_days)

    def ads_window(self, col: Column, dev_days: int | None = 1,
                   incremental: bool = True) -> Column:
        """Ads tables: last 120 days OR the same 120 days one year earlier."""
        if self.mode == DEV and dev_days is not None:
            return D.last_n_days(col, self.run_date, dev_days)
        if self.mode == INCREMENTAL and incremental:
            return D.in_dates(col, self.reload_partitions())
        return D.two_windows(col, self.run_date, 120)


def apply_window(df, cfg: RunConfig, model: str, col: str = "event_date_dt", widen_days: int = 0):
    cond = cfg.window(model, df[col], widen_days)
    return df if cond is None else df.where(cond)
