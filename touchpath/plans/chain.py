"""The attribution chain wired end to end (lazy DataFrames, one plan).

Entry A: session channel groups; entry B: click id -> campaign name; entry C:
daily sessions report.  ``durable`` names the models written to the shared
folder and read back (tables, as the original keeps them), which cuts lineage.
By default these are the two that are read more than once: the columns of the
keyed events that both the page views and the silent sessions need, and the
first/last sources.  They are written as they come from the scan or the
aggregate, without a shuffle of their own; a model with one reader is not
stored, and with ``durable=()`` no job runs before a result is asked for.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from touchpath.config import RunConfig
from touchpath.operators import ads as A
from touchpath.operators import sessions as S
from touchpath.operators.base_events import base_events, keyed_events
from touchpath.operators.reports import daily_sessions
from touchpath.session import configure, size_shuffles
from touchpath.sources import fixtures
from touchpath.sources.ads import SourceRegistry

FIXTURE_RUN_DATE = date(2024, 1, 31)
#: Rows of a stored model's file.  Its rows are narrow, so a split by bytes alone
#: would hold the more rows the better they compress; each file takes at least
#: ``spark.sql.files.openCostInBytes`` of a split.
MODEL_FILE_ROWS = 100_000


@dataclass
class Chain:
    """The models over one set of inputs, as lazy DataFrames.

    Inputs: ``raw_events`` (export rows with ``shard_date``), ``click_tables``
    and ``campaign_tables`` (account label -> path or DataFrame), ``cfg``.
    Outputs (cached properties): ``base`` (M1), ``events`` (M1 without the
    event number), ``clicks`` (M9), ``campaign_names`` (M10),
    ``gclid_campaigns`` (M11), ``silent_sessions`` (M2), ``adjusted`` (M3 or
    M4 by ``variant``), ``traffic`` (M3b), ``first_last`` (M5),
    ``last_user_source`` (M6), ``channel_groups`` (M7), ``session_starts``
    (M8), ``daily`` (M12); ``register_views()`` exposes them to SQL.
    """

    spark: SparkSession
    raw_events: DataFrame
    click_tables: dict
    campaign_tables: dict
    cfg: RunConfig
    variant: str = "gclid"
    numbering: str = "bucketed"
    lookback_strategy: str = "asof"
    overrides: dict = field(default_factory=dict)
    # models written to the shared folder and read back (durable boundaries)
    durable: tuple = ("traffic_events", "first_last")
    _stored: list = field(default_factory=list, repr=False)

    def _boundary(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self.durable:
            return df
        from touchpath.session import scratch_path
        path = scratch_path(self.spark, f"model-{name}")
        df.write.option("maxRecordsPerFile", MODEL_FILE_ROWS).parquet(path)
        self._stored.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Remove the tables that this chain wrote; its DataFrames are of no
        further use."""
        from touchpath.sources.sinks import remove
        while self._stored:
            remove(self.spark, self._stored.pop())

    @cached_property
    def base(self) -> DataFrame:
        if "base" in self.overrides:
            return self.overrides["base"]
        return self._boundary("base", base_events(None, self.cfg, self.numbering, keyed=keyed_events(self.raw_events, self.cfg)))

    @cached_property
    def events(self) -> DataFrame:
        """Keyed events for the downstream models: M1 without its event number
        (the M1 table itself when that is given, or is the one stored)."""
        if "base" in self.overrides or "base" in self.durable:
            return self.base
        return self._boundary("events", keyed_events(self.raw_events, self.cfg))

    @cached_property
    def traffic_events(self) -> DataFrame:
        """The columns that page views and silent sessions read."""
        if "base" in self.overrides or {"base", "events"} & set(self.durable):
            return self.events
        return self._boundary("traffic_events", self.events.select(*S.TRAFFIC_INPUT))

    @cached_property
    def clicks(self) -> DataFrame:
        return A.ads_click_stats(self.spark, self.click_tables, self.cfg)

    @cached_property
    def campaign_names(self) -> DataFrame:
        return A.ads_campaign_names(self.spark, self.campaign_tables, self.cfg)

    @cached_property
    def gclid_campaigns(self) -> DataFrame:
        return A.gclid_campaigns(self.clicks, self.campaign_names)

    @cached_property
    def silent_sessions(self) -> DataFrame:
        return S.non_pageview_sessions(self.events, self.cfg)

    @cached_property
    def adjusted(self) -> DataFrame:
        return self._adjusted(self.events)

    def _adjusted(self, events: DataFrame, stored: bool = False) -> DataFrame:
        if self.variant == "gclid":
            return S.adjust_google_params(events, self.gclid_campaigns, self.cfg, stored)
        return S.adjust_google_params_urlparam(events, self.cfg)

    @cached_property
    def traffic(self) -> DataFrame:
        stored = bool({"traffic_events", "events", "base"} & set(self.durable))
        adjusted, silent = self._adjusted(self.traffic_events, stored), S.non_pageview_sessions(self.traffic_events, self.cfg)
        return self._boundary("traffic", S.with_silent_sessions(adjusted, silent, self.cfg))

    @cached_property
    def first_last(self) -> DataFrame:
        if "first_last" in self.overrides:
            return self.overrides["first_last"]
        return self._boundary("first_last", S.session_first_last_source(self.traffic, self.cfg))

    @cached_property
    def last_user_source(self) -> DataFrame:
        return S.session_last_user_source(self.first_last, self.cfg, strategy=self.lookback_strategy)

    @cached_property
    def channel_groups(self) -> DataFrame:
        return S.session_channel_groups(self.first_last, self.cfg, strategy=self.lookback_strategy)

    @cached_property
    def session_starts(self) -> DataFrame:
        return S.session_starts_enriched(self.events, self.channel_groups, self.cfg)

    @cached_property
    def daily(self) -> DataFrame:
        return daily_sessions(self.session_starts)

    # model name -> chain attribute, for SQL access to every model output
    VIEWS = {
        "base_events": "base",
        "ads_click_stats": "clicks",
        "ads_campaign_names": "campaign_names",
        "gclid_campaigns": "gclid_campaigns",
        "sessions_non_pageview": "silent_sessions",
        "events_pageviews_adjusted": "traffic",
        "session_first_last_source": "first_last",
        "session_last_user_source": "last_user_source",
        "session_channel_groups": "channel_groups",
        "events_session_start": "session_starts",
        "daily_sessions": "daily",
    }

    def register_views(self, prefix: str = "") -> list[str]:
        """Register every model output as a temporary view (lazy: a view is
        planned only when a SQL query reads it)."""
        names = []
        for view, attr in self.VIEWS.items():
            if attr in ("clicks", "campaign_names", "gclid_campaigns") and self.variant != "gclid":
                continue
            getattr(self, attr).createOrReplaceTempView(prefix + view)
            names.append(prefix + view)
        return names


def chain_from_paths(spark: SparkSession, export: str, cfg: RunConfig, ads_root: str | None = None,
                     variant: str = "gclid", registry: SourceRegistry | None = None, **kw) -> Chain:
    """The chain over stored tables: the export's shard folders (only the days
    the base-events window needs are listed) and the ad-account tables of a
    source registry (by default the declared ones below ``ads_root``)."""
    from datetime import timedelta

    from touchpath.sources.ga4 import EXPORT_SCHEMA, read_ga4_shards
    configure(spark)
    incremental = cfg.mode == "incremental"
    days = [cfg.run_date - timedelta(days=i) for i in range(1, (cfg.reload_days if incremental else 120) + 1)]
    raw = read_ga4_shards(spark, export, days=days, schema=EXPORT_SCHEMA, missing="raise" if incremental else "leading")
    if registry is None:
        if variant == "gclid" and not ads_root:
            raise ValueError("the gclid variant needs the ad-account tables")
        registry = SourceRegistry.declared(ads_root) if ads_root else SourceRegistry()
    gclid = variant == "gclid"
    return Chain(spark=spark, raw_events=raw, click_tables=registry.clicks if gclid else {},
                 campaign_tables=registry.campaigns if gclid else {}, cfg=cfg, variant=variant, **kw)


def fixture_registry(spark: SparkSession, sf_dir: str) -> SourceRegistry:
    """The account tables derived from ``events``, by their declared names."""
    paths = fixtures.materialise(spark, sf_dir)
    names = (("clicks", SourceRegistry.CLICKS), ("campaigns", SourceRegistry.CAMPAIGNS), ("shopping", SourceRegistry.SHOPPING))
    return SourceRegistry({f"{prefix}{a}": fixtures.read_table(spark, paths, p) for kind, prefix in names for a, p in paths[kind].items()})


def fixture_chain(spark: SparkSession, sf_dir: str, cfg: RunConfig | None = None, **kw) -> Chain:
    """The chain over GA4- and Ads-shaped tables derived from ``events``."""
    configure(spark)
    paths = fixtures.materialise(spark, sf_dir)
    size_shuffles(spark, paths["rows"])
    registry = fixture_registry(spark, sf_dir)
    return Chain(spark=spark, raw_events=fixtures.read_table(spark, paths, paths["events"]), click_tables=registry.clicks,
                 campaign_tables=registry.campaigns, cfg=cfg or RunConfig(run_date=FIXTURE_RUN_DATE), **kw)
