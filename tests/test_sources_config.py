"""Run-mode date windows, shard reader (intraday, prefer_daily) and the source registry."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from touchpath.config import RunConfig
from touchpath.session import scratch_path
from touchpath.sources import ga4
from touchpath.sources.ads import SourceRegistry, account_labels

RUN = date(2024, 1, 31)


def _days(spark, cfg, model, **kw):
    df = spark.range(0, 200).select(F.date_sub(F.lit(RUN), F.col("id").cast("int")).alias("d"))
    cond = cfg.window(model, F.col("d"), **kw)
    rows = df.collect() if cond is None else df.where(cond).collect()
    return min(r.d for r in rows), max(r.d for r in rows), len(rows)


def test_run_modes(spark):
    full = RunConfig(run_date=RUN)
    assert _days(spark, full, "base_events") == (date(2023, 10, 3), date(2024, 1, 30), 120)
    assert _days(spark, full, "non_pageview_sessions") == (date(2024, 1, 1), date(2024, 1, 30), 30)
    assert _days(spark, full, "session_first_last_source")[2] == 200          # no window
    dev = full.with_(mode="dev")
    assert _days(spark, dev, "pageviews") == (date(2024, 1, 29), date(2024, 1, 30), 2)
    inc = full.with_(mode="incremental", high_water_marks={"session_channel_groups": date(2024, 1, 27)})
    assert _days(spark, inc, "base_events") == (date(2024, 1, 29), date(2024, 1, 30), 2)
    assert _days(spark, inc, "session_channel_groups") == (date(2024, 1, 27), date(2024, 1, 30), 4)
    assert _days(spark, inc, "session_channel_groups", widen_days=3) == (date(2024, 1, 24), date(2024, 1, 30), 7)
    with pytest.raises(KeyError):
        inc.window("pageviews", F.col("d"))


def test_shards_intraday_and_prefer_daily(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), 1), (date(2024, 1, 2), 2), (date(2024, 1, 3), 3)],
                               "shard_date date, v int")
    root = scratch_path(spark, "t-shards")
    ga4.write_ga4_shards(df, root, intraday_days=[date(2024, 1, 3)])
    # the 2nd also arrives as an intraday copy
    df.where("v = 2").drop("shard_date").write.parquet(root + "/shard=events_intraday_20240102")
    got = ga4.read_ga4_shards(spark, root, days=[date(2024, 1, 2), date(2024, 1, 3)])
    assert sorted((r.shard_date, r.v) for r in got.collect()) == [
        (date(2024, 1, 2), 2), (date(2024, 1, 2), 2), (date(2024, 1, 3), 3)]
    got = ga4.read_ga4_shards(spark, root, days=[date(2024, 1, 2), date(2024, 1, 3)], prefer_daily=True)
    assert sorted((r.shard_date, r.v) for r in got.collect()) == [(date(2024, 1, 2), 2), (date(2024, 1, 3), 3)]
    assert ga4.read_ga4_shards(spark, root).count() == 4


def test_registry(spark):
    reg = SourceRegistry()
    df = spark.createDataFrame([(1,)], "x int")
    for acc in account_labels():
        reg.register(f"gads_click_stats_{acc}", df)
    assert sorted(reg.accounts("gads_click_stats_")) == sorted(["de", "at", "de_brand", "at_brand", "ch_brand"])
    reg.create_views(spark)
    assert spark.sql("select count(*) c from gads_click_stats_ch_brand").first().c == 1


def test_missing_shards_raise(spark):
    from datetime import date, timedelta

    import pytest

    from tests.conftest import SF_SMALL
    from touchpath.plans.chain import fixture_chain
    from touchpath.session import scratch_path
    from touchpath.sources.ga4 import EXPORT_SCHEMA, read_ga4_shards, write_ga4_shards

    raw = fixture_chain(spark, SF_SMALL).raw_events
    root = scratch_path(spark, "t-missing")
    write_ga4_shards(raw.where("shard_date BETWEEN '2024-01-05' AND '2024-01-09' AND shard_date != '2024-01-07'"), root)
    days = lambda a, b: [date(2024, 1, 1) + timedelta(days=i) for i in range(a - 1, b)]
    assert read_ga4_shards(spark, root, days(5, 6), schema=EXPORT_SCHEMA).count() > 0
    assert read_ga4_shards(spark, root, days(1, 6), missing="leading").count() > 0
    for wanted, missing in ((days(5, 8), "raise"), (days(5, 8), "leading"), (days(4, 6), "raise"), (days(8, 10), "leading"), (days(20, 21), "allow")):
        with pytest.raises(FileNotFoundError):
            read_ga4_shards(spark, root, wanted, missing=missing)
    assert read_ga4_shards(spark, root, days(5, 8), missing="allow").count() > 0


def test_declared_sources(spark):
    from touchpath.sources.ads import SourceRegistry
    reg = SourceRegistry.declared("/ads/", ["de", "at"], ["de"])
    assert reg.clicks == {"de": "/ads/click_stats_de", "at": "/ads/click_stats_at"}
    assert reg.campaigns["at"] == "/ads/campaigns_at" and reg.shopping == {"de": "/ads/shopping_products_de"}
    reg.register("click_stats_de", "/else/where")
    assert reg.clicks["de"] == "/else/where"


def test_every_declared_table_has_a_name():
    from touchpath.sources.ads import SourceRegistry

    reg = SourceRegistry.declared("/ads", shopping=["de", "at"])
    kinds = {"click_stats": 5, "campaigns": 5, "shopping_products": 2, "search_query_stats": 2, "campaign_stats": 2, "ad_stats": 2,
             "ads": 2, "ad_groups": 2, "ad_group_stats": 2, "criteria": 2, "keywords": 2, "geo_stats": 1}
    assert len(reg.entries) == sum(kinds.values())
    assert reg.clicks.keys() == {"de", "at", "de_brand", "at_brand", "ch_brand"} and reg.entries["geo_stats_de_brand"] == "/ads/geo_stats_de_brand"


def test_unknown_names_and_absent_tables(spark):
    import pytest

    from touchpath.session import scratch_path
    from touchpath.sources.ads import SourceRegistry

    root = scratch_path(spark, "t-sources")
    spark.range(3).write.parquet(f"{root}/keywords_at")
    reg = SourceRegistry.declared(root)
    with pytest.raises(KeyError, match="keywords_at"):
        reg.table(spark, "keywords_fr")
    assert [n for n, there in reg.present(spark).items() if there] == ["keywords_at"]
    assert reg.create_views(spark, only_present=True) == ["keywords_at"]
    assert spark.sql("SELECT count(*) AS n FROM keywords_at").first().n == 3


def _read(df):
    """Rows and distinct files of a read."""
    return {(r.f, r.id) for r in df.selectExpr("_metadata.file_name AS f", "id").collect()}


def test_block_sample_opens_only_its_files(spark):
    """The files of a sample are those whose hash is below the percentage, nested as
    it grows; the scan lists no other file."""
    import hashlib

    from touchpath.session import scratch_path
    from touchpath.sources.sampling import data_files, sampled_files

    root = scratch_path(spark, "t-blocks")
    spark.range(4000).repartition(40).write.parquet(root)
    files = data_files(spark, [root])
    assert len(files) == 40
    every = _read(spark.read.parquet(root))
    last, sizes = set(), []
    for percent in (1, 5, 20, 60, 100):
        chosen = sampled_files(spark, [root], percent, 42)
        assert chosen == sampled_files(spark, [root], percent, 42) and last <= set(chosen)
        place = {p: int(hashlib.md5(f"42|{n}".encode()).hexdigest()[:8], 16) % 10_000 for n, p in files}
        assert set(chosen) == {p for p in place if place[p] < percent * 100 or place[p] == min(place.values())}
        df = spark.read.parquet(*chosen)
        assert sorted(df.inputFiles()) == sorted(spark.read.parquet(*chosen).inputFiles()) and len(df.inputFiles()) == len(chosen)
        names = {p.rpartition("/")[2] for p in chosen}
        assert _read(df) == {r for r in every if r[0] in names}
        sizes.append(len(chosen))
        last = set(chosen)
    assert sizes[0] >= 1 and sizes == sorted(sizes) and sizes[-1] == 40 and sizes[2] < 20
    assert sampled_files(spark, [root], 20, 7) != sampled_files(spark, [root], 20, 42)


def test_block_samples_of_hourly_shards(spark):
    from datetime import date

    from tests.conftest import SF_SMALL
    from touchpath.config import RunConfig
    from touchpath.plans.chain import fixture_chain
    from touchpath.session import scratch_path
    from touchpath.sources import ga4
    from touchpath.sources.sampling import block_place, dev_sample

    raw = fixture_chain(spark, SF_SMALL).raw_events.where("shard_date BETWEEN '2024-01-05' AND '2024-01-06'")
    root = scratch_path(spark, "t-hours")
    ga4.write_ga4_shards(raw, root, by_hour=True)
    days = [date(2024, 1, 5), date(2024, 1, 6)]
    got = ga4.read_ga4_shards(spark, root, days, schema=ga4.EXPORT_SCHEMA, sample_percent=30, sample_unit="folder")
    hours = {(r.d, r.h) for r in got.selectExpr("date_format(shard_date, 'yyyyMMdd') AS d", "cast(floor(event_timestamp / 3600000000) % 24 AS int) AS h").distinct().collect()}
    assert hours and all(block_place(f"shard=events_{d}/hour={h}", 42) < 3000 for d, h in hours)
    whole = raw.selectExpr("date_format(shard_date, 'yyyyMMdd') AS d", "cast(floor(event_timestamp / 3600000000) % 24 AS int) AS h")
    assert got.count() == sum((r.d, r.h) in hours for r in whole.collect())
    cfg = RunConfig(run_date=date(2024, 1, 7), mode="dev", dev_sampling="blocks")
    assert dev_sample(got, cfg) is got
