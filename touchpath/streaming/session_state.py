"""First and last source per session, kept as mergeable states.

The original rebuilds this model over all history on every run.  Here each event
day leaves one partial state per session (the least event and the greatest event
with a source, each with its order key), and a session's row is the merge of its
partial states.  Two tables are kept:

* ``session_states``: partial states, one row per (session, event day), partitioned
  by event day and by the day the session started;
* ``session_first_last_source``: the finished rows, partitioned by the day the
  session started.

The start day is a function of the session key's own members (the session id is
its start in seconds), so all states of a session lie under one start day, and a
run needs to read and replace only the start days that its event days touch,
whatever the length of the history.  A run reads the new event days of the traffic
table, writes their partial states in place of what those days held before (late
hits, emptied days), and merges the touched start days anew.

Sessions without a key or with a start outside the calendar below share the
partition without a value.  The finished rows are replaced before the states: a run
that fails in between is repeated by the next one, which starts at the states' mark.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.config import RunConfig
from touchpath.operators import sessions as S
from touchpath.sources import sinks

START_DAY = "session_start_day"
#: Starts that get a partition of their own: others are not dates of sessions.
EARLIEST, LATEST = date(2010, 1, 1), date(2100, 1, 1)


def start_day() -> Column:
    """UTC day of ``session_start_time``; NULL without a session key or outside
    the calendar."""
    start = F.col("session_start_time")
    epoch = lambda d: (d - date(1970, 1, 1)).days * 86_400
    ok = F.col("session_key").isNotNull() & (start >= epoch(EARLIEST)) & (start < epoch(LATEST))
    return F.date_from_unix_date(F.floor(F.when(ok, start) / 86_400).cast("int"))


def in_start_days(days: list[date | None]) -> Column:
    """A literal list, so it prunes partitions."""
    known = sorted(d for d in days if d is not None)
    cond = F.col(START_DAY).isin(known) if known else F.lit(False)
    return cond | F.col(START_DAY).isNull() if None in days else cond


class FirstLastState:
    """The two tables below ``root`` and how a run advances them."""

    def __init__(self, spark: SparkSession, root: str, drop_null_keys: bool = False) -> None:
        self.spark, self.drop_null_keys = spark, drop_null_keys
        self.states = f"{root.rstrip('/')}/session_states"
        self.finished = f"{root.rstrip('/')}/session_first_last_source"
        #: start days that the last run replaced, and the event day it began with
        self.touched: list[date | None] = []
        self.since: date | None = None

    def table(self) -> DataFrame:
        return self.spark.read.parquet(self.finished)

    def partial(self, traffic: DataFrame, since: date | None) -> DataFrame:
        """States of the sessions of each event day from ``since`` on."""
        rows = traffic if since is None else traffic.where(F.col("event_date_dt") >= F.lit(since))
        if self.drop_null_keys:
            rows = rows.where(F.col("session_key").isNotNull())
        return S.source_states(rows.withColumn(START_DAY, start_day()), "session_key", START_DAY, "event_date_dt")

    def earlier(self, schema, days: list[date | None], since: date) -> DataFrame:
        """Stored states of the start days ``days``, of event days before ``since``."""
        old = self.spark.read.schema(schema).parquet(self.states)
        day = F.col("event_date_dt")
        return old.where((day.isNull() | (day < F.lit(since))) & in_start_days(days))

    def merged(self, states: DataFrame) -> DataFrame:
        """The finished rows of partial states."""
        return S.first_last_of(S.merged_states(states, "session_key", START_DAY), START_DAY)

    def _stored(self, since: date) -> dict[date, list[date | None]]:
        """Start days by event day from ``since`` on, from the folders' listing."""
        days = [d for d in sinks.partition_days(self.spark, self.states, "event_date_dt") if d is not None and d >= since]
        return {d: sinks.partition_days(self.spark, f"{self.states}/{sinks.partition_name('event_date_dt', d)}", START_DAY) for d in days}

    def advance(self, traffic: DataFrame, since: date | None = None) -> list[date | None]:
        """Bring the tables up to ``traffic`` (the traffic events table), whose event
        days from ``since`` on are new or were written anew; without a stored
        state, or without ``since``, everything is built.  Returns the start days
        whose rows were replaced."""
        mark = sinks.high_water_mark(self.spark, self.states)
        since = None if since is None or mark is None else min(since, mark)
        with sinks.staging(self.spark, self.states, "partial") as tmp:
            new = self.partial(traffic, since)
            new.write.parquet(tmp)
            new = self.spark.read.schema(new.schema).parquet(tmp)
            found = new.select("event_date_dt", START_DAY).distinct().collect()  # at most one row per pair of days
            if since is None:
                sinks.write_full(self.merged(new), self.finished, partition_by=START_DAY, cluster_by=["session_key"])
                sinks.remove(self.spark, self.states)
                self.touched = sorted({r[START_DAY] for r in found}, key=str)
                stale = {}
            else:
                stale = self._stored(since)
                self.touched = sorted({r[START_DAY] for r in found} | {d for days in stale.values() for d in days}, key=str)
                rows = self.merged(self.earlier(new.schema, self.touched, since).unionByName(new))
                sinks.write_static(self.spark, rows, self.finished, START_DAY, self.touched, cluster_by=["session_key"])
            (new.hint("rebalance", "event_date_dt", START_DAY).sortWithinPartitions("event_date_dt", START_DAY, "session_key")
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date_dt", START_DAY).parquet(self.states))
            kept = {(r["event_date_dt"], r[START_DAY]) for r in found}
            for day, starts in stale.items():
                for start in starts:
                    if (day, start) not in kept:
                        folder = f"{self.states}/{sinks.partition_name('event_date_dt', day)}"
                        sinks.remove(self.spark, f"{folder}/{sinks.partition_name(START_DAY, start)}")
        self.since = since
        return self.touched

    def behind(self, cfg: RunConfig, since: date | None, lookback_seconds: int) -> DataFrame:
        """The finished rows that the channel groups of event days from ``since``
        on need: theirs, and those of the look-back before the earliest of them.

        A session of these days has no earlier event, so it lies in a start day
        that the run replaced: the bound is found there, and the rest of the
        history is not read."""
        table = self.table()
        if since is None or self.since is None or since < self.since:
            return table
        ours = table.where(in_start_days(self.touched) & (F.col("event_date_dt") >= F.lit(since)) & F.col(START_DAY).isNotNull())
        least = ours.agg(F.min(START_DAY)).first()[0]
        if least is None:
            return table.where(F.col(START_DAY).isNull() | (F.col("event_date_dt") >= F.lit(since)))
        first = date.fromordinal(least.toordinal() - -(-lookback_seconds // 86_400) - 1)
        return table.where(F.col(START_DAY).isNull() | (F.col(START_DAY) >= F.lit(first)))
