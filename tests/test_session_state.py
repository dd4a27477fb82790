"""First and last source as mergeable states: daily runs equal a rebuild, and read and replace only what their days touch."""

import os
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_first_last import COLS
from touchpath.config import RunConfig
from touchpath.operators.sessions import session_first_last_source
from touchpath.functions.traffic import traffic_struct
from touchpath.session import scratch_path
from touchpath.streaming.session_state import START_DAY, FirstLastState

FIRST = date(2024, 1, 1)


def events(seed, days=12, n=600):
    """Sessions over one to three days, some much longer, some without key or start."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        began = rng.randrange(days)
        start = (FIRST + timedelta(days=began) - date(1970, 1, 1)).days * 86_400 + rng.randrange(86_400)
        user = f"u{rng.randrange(40)}"
        key, start = rng.choice([(f"{user}-{start}", start)] * 8 + [(None, start), (f"{user}-7", 7), (f"{user}-null", None)])
        for _ in range(rng.randrange(1, 5)):
            day = min(days - 1, began + rng.choice([0, 0, 0, 1, 2, 9]))
            src = rng.choice([None, None, "google", "news"])
            out.append((FIRST + timedelta(days=day), key, user, (began * 86_400 + rng.randrange(500)) * 1_000_000, "page_view", rng.choice([None, "start"]), start,
                        None, None, None, None, None, None, src, rng.choice(["cpc", None]) if src else None, rng.choice([None, "c"]), f"e{i}-{rng.randrange(5)}"))
    return out


def traffic(spark, rows):
    return spark.createDataFrame(rows, COLS).withColumn("traffic_source_struct", traffic_struct())


def same(a, b):
    cols = [c for c in b.columns if c != START_DAY]
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def rebuilt(spark, rows, **kw):
    return session_first_last_source(traffic(spark, rows), RunConfig(run_date=date(2024, 3, 1), **kw))


@pytest.mark.parametrize("drop", [False, True])
def test_daily_runs_equal_a_rebuild(spark, drop):
    """Late hits come, hits of a reloaded day vanish, days are skipped."""
    rows, rng = events(1), random.Random(2)
    state = FirstLastState(spark, scratch_path(spark, "t-state"), drop)
    seen, since = [], None
    for last in (3, 4, 5, 8, 11):
        upto = FIRST + timedelta(days=last)
        new = [r for r in rows if r[0] <= upto and (since is None or r[0] >= since)]
        new = [r for r in new if r[0] < upto or last == 11 or rng.random() < 0.7]  # the last day is not complete yet
        seen = [r for r in seen if since is not None and r[0] < since] + new
        state.advance(traffic(spark, seen), since)
        assert same(state.table(), rebuilt(spark, seen, drop_null_keys=drop))
        assert state.table().groupBy("session_key").count().where("count > 1").isEmpty()
        since = upto
    assert same(state.table(), rebuilt(spark, rows, drop_null_keys=drop))


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_run_reads_and_replaces_only_touched_start_days(spark):
    rows = [r for r in events(3) if r[6] is None or r[6] > 7]
    rows = [r for r in rows if r[6] is None or (r[0] - date(1970, 1, 1)).days - r[6] // 86_400 <= 2]  # no session of over two days
    rows = [r for r in rows if r[1] is not None and r[6] is not None]
    state = FirstLastState(spark, scratch_path(spark, "t-state"))
    since = FIRST + timedelta(days=10)
    state.advance(traffic(spark, [r for r in rows if r[0] <= since]))
    before = {t: files(getattr(state, t)) for t in ("states", "finished")}
    touched = state.advance(traffic(spark, rows), since)
    assert set(touched) <= {FIRST + timedelta(days=d) for d in (8, 9, 10, 11)}
    kept = {t: before[t] & files(getattr(state, t)) for t in before}
    names = {f"{START_DAY}={d.isoformat()}" for d in touched}
    assert {f for f in before["finished"] if not any(n in f for n in names)} == {f for f in kept["finished"]}
    assert all(f"event_date_dt={since.isoformat()}" not in f for f in kept["states"])
    assert {f for f in before["states"] if f"event_date_dt={since.isoformat()}" not in f} == kept["states"]
    # the plan that merges prunes the stored states on both partition columns
    partial = state.partial(traffic(spark, rows), since)
    plan = state.merged(state.earlier(partial.schema, touched, since).unionByName(partial))._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*\)?[^\]]*)\]", plan)
    assert filters and "event_date_dt" in filters[0] and START_DAY in filters[0]


def test_emptied_days_and_vanished_sessions(spark):
    rows = events(4, days=4, n=80)
    state = FirstLastState(spark, scratch_path(spark, "t-state"))
    state.advance(traffic(spark, rows))
    last = FIRST + timedelta(days=3)
    left = [r for r in rows if r[0] != last] + [r for r in rows if r[0] == last][:1]
    state.advance(traffic(spark, left), last)
    assert same(state.table(), rebuilt(spark, left))
    left = [r for r in left if r[0] != last]
    state.advance(traffic(spark, left), last)
    assert same(state.table(), rebuilt(spark, left))


def test_a_missing_state_is_built_from_all_days(spark):
    rows = events(5, days=3, n=50)
    state = FirstLastState(spark, scratch_path(spark, "t-state"))
    state.advance(traffic(spark, rows), FIRST + timedelta(days=2))
    assert state.since is None and same(state.table(), rebuilt(spark, rows))


def test_look_back_reads_the_sessions_it_needs(spark):
    rows = [r for r in events(6) if r[1] is not None and (r[6] or 0) > 7]
    state = FirstLastState(spark, scratch_path(spark, "t-state"))
    since = FIRST + timedelta(days=10)
    state.advance(traffic(spark, [r for r in rows if r[0] <= since]))
    state.advance(traffic(spark, rows), since)
    cfg = RunConfig(run_date=FIRST + timedelta(days=12))
    from touchpath.operators.sessions import session_last_user_source

    day = F.col("event_date_dt") >= F.lit(since)
    for lookback in (3600, 2 * 86_400, 90 * 86_400):
        few = state.behind(cfg, since, lookback)
        a = session_last_user_source(few, cfg, lookback).where(day)
        b = session_last_user_source(state.table(), cfg, lookback).where(day)
        assert same(a, b) and a.count() > 0
    assert state.behind(cfg, since, 3600).count() <= state.table().count()
