"""Incremental runner: durable, date-partitioned model tables advanced per run date.

Per run (``run_date`` = today):

* ad click stats   – static overwrite of the reload days by ingestion date (a
                     late click lands beside the earlier ones of its click date)
* campaign names   – the reload days and those that enter or leave the model's windows
                     (or, with carried names, from the kept state on); click id ->
                     campaign name is read as a view
* base events      – static overwrite of the reload days by shard date (late hits)
* silent sessions  – static overwrite of [high-water mark, yesterday]
* traffic events   – dynamic overwrite of [high-water mark, yesterday]
* first/last       – states of the new event days merged into the kept ones; only
                     the session start days they touch are read and replaced
* channel groups   – dynamic overwrite of [high-water mark, yesterday]
* session starts   – dynamic overwrite of [high-water mark, yesterday]
* data tests       – the model test suite, appended per run date; its counts were
                     observed while the models were written

The reload days are the configured number, or as many as lie between a target's
high-water mark and the run date: a skipped run leaves no hole.

The first run of a target (no table yet) is a full refresh; incremental
writes of the analytics models refuse a schema change.  Every step reads
the previous step's *table*, so a lost executor only repeats the step that was
running, and each step's lineage starts at a table in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.config import FULL, INCREMENTAL, RunConfig
from touchpath.operators import ads as A
from touchpath.operators import quality as Q
from touchpath.operators import sessions as S
from touchpath.operators.base_events import base_events, keyed_events
from touchpath.session import configure
from touchpath.sources import sinks
from touchpath.sources.ads import resolve
from touchpath.streaming.campaign_state import CampaignNames
from touchpath.streaming.day_metrics import DayMetrics
from touchpath.streaming.session_state import FirstLastState

MODEL_TABLES = ("ads_click_stats", "ads_campaign_names", "base_events", "silent_sessions", "traffic_events",
                "session_states", "session_first_last_source", "session_channel_groups", "session_starts", "dq_results")

#: Partition column of the tables that are not partitioned by event date.
PARTITIONS = {"ads_click_stats": A.INGESTION_DATE, "ads_campaign_names": "date", "base_events": "shard_date"}


@dataclass
class IncrementalRunner:
    spark: SparkSession
    root: str
    raw_events: DataFrame
    click_tables: dict
    campaign_tables: dict
    variant: str = "gclid"
    base_cfg: RunConfig | None = None
    # shopping-product tables: read by their day-coverage test alone
    shopping_tables: dict = field(default_factory=dict)
    # campaign names: the last one that was not NULL, also of earlier days
    carry_names: bool = False
    # schemas of tables written by this runner: read back without inference
    _schemas: dict = field(default_factory=dict, repr=False)

    @property
    def metrics(self) -> DayMetrics:
        return DayMetrics(self.spark, self.root)

    def path(self, model: str) -> str:
        return f"{self.root.rstrip('/')}/{model}"

    def table(self, model: str) -> DataFrame:
        schema = self._schemas.get(model)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(model))

    def _written(self, model: str, df: DataFrame) -> None:
        self._schemas[model] = df.schema

    def reload_days(self, run_date: date) -> list[date]:
        """Shard days that a run reads: the window of a first load, else the
        reload days and whatever was skipped since the last one."""
        cfg = self._cfg(run_date, "base_events", [])
        return cfg.reload_partitions(120 if cfg.mode == FULL else None)

    def _cfg(self, run_date: date, target: str, model_keys: list[str]) -> RunConfig:
        base = self.base_cfg or RunConfig(run_date=run_date)
        hwm = sinks.high_water_mark(self.spark, self.path(target), PARTITIONS.get(target, "event_date_dt"))
        if hwm is None:
            return base.with_(run_date=run_date, mode=FULL)
        if hwm >= run_date:
            raise ValueError(f"{target} is loaded up to {hwm}: a run for {run_date} would go back in time")
        # the mark's own day is reloaded too: it may have been partial
        return base.with_(run_date=run_date, mode=INCREMENTAL, high_water_marks={k: hwm for k in model_keys},
                          reload_days=max(base.reload_days, (run_date - hwm).days))

    def load_clicks(self, run_date: date) -> None:
        """The click table: the ingestion-date window picks the rows, and the
        same date partitions the table."""
        cfg = self._cfg(run_date, "ads_click_stats", [])
        clicks = A.ads_click_stats(self.spark, self.click_tables, cfg, with_ingestion=True)
        if cfg.mode == FULL:
            sinks.write_full(clicks, self.path("ads_click_stats"), partition_by=A.INGESTION_DATE, cluster_by=["account", "date"])
        else:
            sinks.write_static(self.spark, clicks, self.path("ads_click_stats"), A.INGESTION_DATE, cfg.reload_partitions(),
                               cluster_by=["account", "date"], guard_schema=True)
        self._written("ads_click_stats", clicks)

    def load_base(self, run_date: date) -> None:
        """Base events: reload days by shard date, emptied when a day lost its
        input (an event whose own date differs stays in its shard's partition)."""
        cfg = self._cfg(run_date, "base_events", [])
        path, cluster = self.path("base_events"), ["event_date_dt", "event_name"]
        # the keyed events are stored for the run: the export is read once
        with sinks.staging(self.spark, path, "keyed") as tmp:
            keyed = keyed_events(self.raw_events, cfg)
            keyed.write.parquet(tmp)
            base = base_events(None, cfg, keyed=self.spark.read.schema(keyed.schema).parquet(tmp), with_shard=True)
            if cfg.mode == FULL:
                sinks.write_full(base, path, partition_by="shard_date", cluster_by=cluster)
            else:
                sinks.write_static(self.spark, base, path, "shard_date", cfg.reload_partitions(), cluster_by=cluster, guard_schema=True)
            self._written("base_events", base)

    def run(self, run_date: date, with_tests: bool = True) -> dict[str, str]:
        configure(self.spark)
        sp = self.spark

        if self.variant == "gclid":
            self.load_clicks(run_date)
            names = CampaignNames(sp, self.root, self.campaign_tables, self.carry_names)
            self._schemas["ads_campaign_names"] = names.advance(run_date, self._cfg(run_date, "ads_campaign_names", []).reload_days)

        self.load_base(run_date)
        base_t = self.table("base_events")

        # silent sessions: static over the whole reprocessed range (a day that
        # no longer has silent sessions is emptied)
        cfg = self._cfg(run_date, "silent_sessions", ["non_pageview_sessions"])
        silent = S.non_pageview_sessions(base_t, cfg)
        self._write(cfg, silent, "silent_sessions", static=True, hwm_model="non_pageview_sessions")
        silent_t = self.table("silent_sessions")

        # traffic events (page views repaired + silent sessions)
        cfg = self._cfg(run_date, "traffic_events", ["pageviews", "silent_sessions", "gclid_names"])
        if self.variant == "gclid":
            gclids = A.gclid_campaigns(self.table("ads_click_stats"), self.table("ads_campaign_names"))
            adj = S.adjust_google_params(base_t, gclids, cfg, stored=True)
        else:
            adj = S.adjust_google_params_urlparam(base_t, cfg)
        traffic = S.with_silent_sessions(adj, silent_t, cfg)
        self._write(cfg, traffic, "traffic_events", static=False, hwm_model="pageviews")

        # first/last source: the new event days merged into the kept states
        state = FirstLastState(sp, self.root, (self.base_cfg or cfg).drop_null_keys)
        state.advance(self.table("traffic_events"), None if cfg.mode == FULL else cfg.hwm("pageviews"))

        cfg = self._cfg(run_date, "session_channel_groups", ["session_channel_groups"])
        fl_t = state.behind(cfg, None if cfg.mode == FULL else cfg.hwm("session_channel_groups"), cfg.lookback_seconds)
        cg = S.session_channel_groups(fl_t, cfg)
        self._write(cfg, cg, "session_channel_groups", static=False, hwm_model="session_channel_groups")

        cfg = self._cfg(run_date, "session_starts", ["session_starts"])
        starts = S.session_starts_enriched(base_t, self.table("session_channel_groups"), cfg)
        self._write(cfg, starts, "session_starts", static=False, hwm_model="session_starts")

        if with_tests:
            dq = self.metrics.suite(self.table, run_date)
            if self.shopping_tables:
                tables = {a: resolve(sp, t) for a, t in self.shopping_tables.items()}
                dq = dq.unionByName(Q.source_day_coverage(tables, "segments_date", Q.SHOPPING_SINCE, run_date, "shopping_products"))
            (dq.withColumn("run_date", F.lit(run_date)).write.mode("overwrite")
               .option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(self.path("dq_results")))
        return {m: self.path(m) for m in MODEL_TABLES}

    def backfill(self, first: date, last: date, with_tests: bool = True) -> dict[str, str]:
        """Advance the tables one run date at a time from ``first`` to ``last``
        (each run is its own set of Spark jobs; nothing passes the driver)."""
        paths = {}
        for o in range(first.toordinal(), last.toordinal() + 1):
            paths = self.run(date.fromordinal(o), with_tests=with_tests)
        return paths

    def _write(self, cfg: RunConfig, df: DataFrame, model: str, static: bool, hwm_model: str):
        path = self.path(model)
        self._written(model, df)
        if cfg.mode == FULL:
            sinks.write_full(df, path, cluster_by=["session_key"])
            self.metrics.forget(model)
            return
        # incremental loads refuse a schema change (policy: fail)
        hwm = cfg.hwm(hwm_model)
        days = [date.fromordinal(o) for o in range(hwm.toordinal(), cfg.run_date.toordinal())]
        observe = self.metrics.observation(model, days)
        if static:
            sinks.write_static(self.spark, df, path, "event_date_dt", days, cluster_by=["session_key"],
                               guard_schema=True, observe=observe)
        else:
            sinks.write_dynamic(df, path, cluster_by=["session_key"], guard_schema=True, observe=observe)
        if observe is not None:
            self.metrics.record(model, days, observe[0], emptied=static)
