"""Campaign names advanced by new snapshots: equal to a rebuild, whatever the runs."""

import random
from datetime import date, timedelta

import pytest

from touchpath.config import RunConfig
from touchpath.operators.ads import ads_campaign_names
from touchpath.session import scratch_path
from touchpath.sources import sinks
from touchpath.streaming.campaign_state import CampaignNames, window_days

CAMP = "customer_id bigint, campaign_id bigint, campaign_name string, _partition_date date"
D0 = date(2024, 1, 1)


def at(n):
    return D0 + timedelta(days=n)


def snapshots(seed, days):
    """Rows of two accounts: NULL names, NULL ids, gaps, several customers a day."""
    rng = random.Random(seed)
    return {a: [(rng.choice([1, 2, None]), c, rng.choice([None, None, "x", "y", f"n{d.day}"]), d)
                for d in days for c in (7, 8, None) for _ in range(rng.randint(0, 2))] for a in ("de", "at")}


def frames(spark, rows, until=None):
    return {a: spark.createDataFrame([r for r in rr if until is None or r[3] <= until], CAMP) for a, rr in rows.items()}


def rows_of(df):
    return sorted(map(repr, df.select("date", "customer_id", "campaign_id", "campaign_name", "campaign_name_last_value", "sk_id").collect()))


def carried(rows, first, last):
    """(date, customer, campaign, name, last name), by going through all days."""
    out = []
    for rr in rows.values():
        for c in {r[1] for r in rr}:
            name = None
            for d in sorted({r[3] for r in rr}):
                today = [r for r in rr if r[1] == c and r[3] == d and first <= d <= last]
                known = [r for r in today if r[2] is not None]
                if known:
                    name = max(known, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))[2]
                out += [(d, r[0], c, r[2], name) for r in today]
    return sorted(map(repr, out))


@pytest.mark.parametrize("seed, runs", [(1, (5, 6, 7, 8)), (2, (4, 9, 10)), (3, (3, 12))])
def test_carried_names_equal_all_days_at_once(spark, seed, runs):
    rows = snapshots(seed, [at(n) for n in (-200, -3, 0, 1, 2, 3, 5, 6, 7, 9, 10, 11)])
    root = scratch_path(spark, "t-carry")
    for n in runs:
        c = CampaignNames(spark, root, frames(spark, rows, at(n - 1)), carry=True)
        c.advance(at(n))
    got = sorted(repr(tuple(r)) for r in c.table().select("date", "customer_id", "campaign_id", "campaign_name", "campaign_name_last_value").collect())
    assert got == carried(rows, at(-500), at(runs[-1] - 1))
    assert min(c.loaded) >= at(runs[-2] - 3)                       # the past is not read again
    assert len(sinks.partition_days(spark, c.states, "as_of")) == 1


def test_partial_last_day_and_more_reload_days(spark):
    rows = snapshots(4, [at(n) for n in range(10)])
    root = scratch_path(spark, "t-partial")
    part = {a: [r for i, r in enumerate(rr) if r[3] < at(4) or i % 2] for a, rr in rows.items()}
    CampaignNames(spark, root, frames(spark, part, at(4)), carry=True).advance(at(5))
    c = CampaignNames(spark, root, frames(spark, rows, at(6)), carry=True)
    c.advance(at(7))
    c.advance(at(8), reload_days=6)                                # before the kept state: loaded anew
    got = sorted(repr(tuple(r)) for r in c.table().select("date", "customer_id", "campaign_id", "campaign_name", "campaign_name_last_value").collect())
    assert got == carried(rows, at(-500), at(6))
    assert min(c.loaded) == at(0)


@pytest.mark.parametrize("runs", [(5, 6, 7), (5, 40, 41), (5, 200)])
def test_names_of_the_day_equal_a_rebuild(spark, runs):
    """Days that enter the windows (of this year and of the last) are loaded, those
    that leave them are dropped."""
    rows = snapshots(5, [at(n) for n in (-485, -484, -480, -361, -360, -330, -329, -170, -115, -100, 0, 3, 4, 5, 6, 38, 39, 40, 198)])
    root = scratch_path(spark, "t-days")
    for n in runs:
        c = CampaignNames(spark, root, frames(spark, rows, at(n - 1)))
        c.advance(at(n))
    full = ads_campaign_names(spark, frames(spark, rows, at(runs[-1] - 1)), RunConfig(run_date=at(runs[-1])))
    assert full.count() > 0 and rows_of(c.table()) == rows_of(full)
    kept = [d for d in c.loaded if d in window_days(at(runs[-2])) and d < at(runs[-2] - 2)]
    assert not {r[3] for rr in rows.values() for r in rr}.intersection(kept)   # stored days are not read again


def test_empty_tables_and_going_back(spark):
    root = scratch_path(spark, "t-none")
    empty = {"de": spark.createDataFrame([], CAMP)}
    for carry in (False, True):
        c = CampaignNames(spark, f"{root}-{carry}", empty, carry)
        c.advance(at(5))
        c.advance(at(6))
        assert c.table().count() == 0
        CampaignNames(spark, f"{root}-{carry}", {"de": spark.createDataFrame([(1, 7, "a", at(5))], CAMP)}, carry).advance(at(6))
        with pytest.raises(ValueError):
            c.advance(at(5))


def test_a_run_reads_its_days_alone(spark):
    """Files of other days are not opened: they are gone."""
    rows = snapshots(6, [at(n) for n in range(8)])
    stored = scratch_path(spark, "t-snap")
    for a, df in frames(spark, rows).items():
        df.write.partitionBy("_partition_date").parquet(f"{stored}/{a}")
    tables = {a: f"{stored}/{a}" for a in rows}
    root = scratch_path(spark, "t-pruned")
    c = CampaignNames(spark, root, tables, carry=True)
    c.advance(at(6))
    for n in range(3):
        for a in rows:
            sinks.remove(spark, f"{stored}/{a}/{sinks.partition_name('_partition_date', at(n))}")
    c.advance(at(8))
    got = sorted(repr(tuple(r)) for r in c.table().select("date", "customer_id", "campaign_id", "campaign_name", "campaign_name_last_value").collect())
    assert got == carried(rows, at(-500), at(7))
