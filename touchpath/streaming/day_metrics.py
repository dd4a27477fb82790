"""Data tests without a second read: counts per model and event day, taken while a
model is written.

An incremental load writes a few known days, so its write carries observed metrics:
rows and failing rows of each of those days.  They are appended to a small table per
model, where the counts of a day's last load hold; the tests then sum that table.
The metrics are observed in the last stage of the write, whose tasks count once even
if a lost executor makes Spark repeat others.  After a full load, or where the table
is missing, the counts of all days come from one grouped read.

Uniqueness has no mergeable count; its tests read the days they are about.
"""

from __future__ import annotations

import time
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchpath.operators import quality as Q
from touchpath.sources import sinks

DAY = "event_date_dt"
SCHEMA = f"{DAY} date, metric string, n bigint, load bigint"
ROWS = "rows"
#: Appended loads from which on a model's table is written anew.
COMPACT = 60


def _failing(model: str) -> dict[str, Column]:
    """Metric -> the rows it counts."""
    kind = F.col("session_gadscampaign")
    return {
        "silent_sessions": {},
        "traffic_events": {"odd_kind": kind.isNotNull() & ~kind.isin(Q.GADS_CAMPAIGN_TYPES), "no_session": F.col("session_key").isNull(),
                           "no_user": F.col("user_key").isNull()},
        "session_starts": {"no_key": F.col("sk_id").isNull()},
    }[model]


class DayMetrics:
    MODELS = ("silent_sessions", "traffic_events", "session_starts")

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, model: str) -> str:
        return f"{self.root}/dq_metrics/{model}"

    def table(self, model: str) -> DataFrame:
        """(event_date_dt, metric, n): the counts of each day's last load."""
        log = self.spark.read.schema(SCHEMA).parquet(self.path(model))
        return log.groupBy(DAY, "metric").agg(F.max_by("n", "load").alias("n")).where("n > 0")

    def observation(self, model: str, days: list[date]) -> tuple[Observation, list[Column]] | None:
        """What a write of ``days`` observes; nothing while the table is missing, or
        if it ends before the model does (a run failed between the two): then it is
        dropped, and the next tests count anew."""
        if model not in self.MODELS or not days or not sinks.exists(self.spark, self.path(model)):
            return None
        mark = sinks.high_water_mark(self.spark, f"{self.root}/{model}", DAY)
        if mark is not None and mark != self.table(model).where(F.col("metric") == ROWS).agg(F.max(DAY)).first()[0]:
            self.forget(model)
            return None
        metrics = {ROWS: F.lit(True), **_failing(model)}
        on = lambda d: F.col(DAY) == F.lit(d)
        return Observation(), [F.count_if(on(d) & cond).alias(f"{name}|{d.isoformat()}") for d in days for name, cond in metrics.items()]

    def record(self, model: str, days: list[date], observation: Observation, emptied: bool) -> None:
        """Put the observed counts in place of those days' rows; a day without rows
        keeps its counts unless the write ``emptied`` it."""
        found = observation.get
        written = [d for d in days if emptied or found[f"{ROWS}|{d.isoformat()}"]]
        if not written:
            return
        rows = [F.struct(F.lit(d).alias(DAY), F.lit(key.split("|")[0]).alias("metric"), F.lit(n).cast("bigint").alias("n"))
                for d in written for key, n in found.items() if key.endswith(d.isoformat())]
        new = self.spark.range(1).select(F.explode(F.array(*rows)).alias("m")).select("m.*", F.lit(time.time_ns()).alias("load"))
        new.coalesce(1).write.mode("append").parquet(self.path(model))
        if len(sinks.files(self.spark, self.path(model))) > COMPACT:
            sinks.write_full(self.table(model).withColumn("load", F.lit(time.time_ns())).coalesce(1), self.path(model), partition_by=None)

    def rebuild(self, model: str, table: DataFrame) -> None:
        """The counts of all days of a model's table."""
        metrics = {ROWS: F.lit(True), **_failing(model)}
        per = table.groupBy(DAY).agg(*[F.count_if(cond).alias(name) for name, cond in metrics.items()])
        each = F.explode(F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).alias("n")) for name in metrics])).alias("m")
        sinks.write_full(per.select(DAY, each).select(DAY, "m.*", F.lit(time.time_ns()).alias("load")).coalesce(1), self.path(model), partition_by=None)

    def forget(self, model: str) -> None:
        sinks.remove(self.spark, self.path(model))

    def suite(self, tables, run_date: date) -> DataFrame:
        """The results of :func:`quality.model_suite`; ``tables(model)`` gives a
        model's table, for the uniqueness tests and for counts that are missing."""
        for model in self.MODELS:
            if not sinks.exists(self.spark, self.path(model)):
                self.rebuild(model, tables(model))
        days = lambda n: run_date - timedelta(days=n)
        named = lambda metric: F.col("metric") == metric
        total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")
        missing = lambda n: F.lit(n) - F.count_if(named(ROWS) & F.col(DAY).between(F.lit(days(n)), F.lit(days(1))))
        last7 = F.col(DAY).between(F.lit(days(7)), F.lit(days(1)))
        checks = {
            "silent_sessions": [("silent_sessions:day_coverage", missing(30), "warn", 0)],
            "traffic_events": [("pageviews:day_coverage", missing(44), "warn", 0),
                               ("pageviews:session_gadscampaign_in_set", total(named("odd_kind") & last7), "warn", 5),
                               ("pageviews:session_key_not_null", total(named("no_session")), "error", 0),
                               ("pageviews:user_key_not_null", total(named("no_user")), "error", 0)],
            "session_starts": [("session_starts:day_coverage", missing(10), "warn", 0),
                               ("session_starts:sk_id_not_null", total(named("no_key")), "error", 0)],
        }
        out = Q.uniqueness_suite(tables("session_channel_groups"), tables("session_starts"), run_date)
        for model, tests in checks.items():
            sums = self.table(model).agg(*[n.alias(f"c{i}") for i, (_, n, _, _) in enumerate(tests)])
            out = out.unionByName(Q.result_rows(sums, [(name, F.col(f"c{i}"), severity, warn) for i, (name, _, severity, warn) in enumerate(tests)]))
        return out
