"""First / last source per session: NULL first, all NULL, ties, struct with NULL fields."""

import random
from datetime import date

from touchpath.config import RunConfig
from touchpath.operators.sessions import session_first_last_source, with_silent_sessions

COLS = ("event_date_dt date, session_key string, user_key string, event_timestamp long, event_name string, "
        "page_pagetype string, session_start_time long, gclid string, session_gadscampaign string, "
        "session_gadsbraid string, entrances long, page_referrer string, page_location string, source string, "
        "medium string, campaign string, sk_id string")
D = date(2024, 1, 10)


def _row(sk, ts, eid, source=None, medium=None, campaign=None, ptype=None, user="u"):
    return (D, sk, user, ts, "page_view", ptype, 100, None, None, None, None, None, None, source, medium, campaign, eid)


def _run(spark, rows):
    df = spark.createDataFrame(rows, COLS)
    silent = spark.createDataFrame([], COLS).drop("sk_id")
    cfg = RunConfig(run_date=date(2024, 1, 31))
    t = with_silent_sessions(df, silent, cfg)
    out = session_first_last_source(t, cfg).collect()
    f = lambda s: None if s is None else (s.source, s.medium, s.campaign, s.page_pagetype)
    return {r.session_key: (f(r.first_value_session), f(r.last_non_null_value_session)) for r in out}


def test_edges(spark):
    rows = [
        _row("a", 1, "e1"), _row("a", 2, "e2", "google", "organic"),               # first NULL, then source
        _row("b", 1, "e3"), _row("b", 2, "e4", None, None, "only_campaign"),        # all direct
        _row("c", 5, "e6", "x", "m"), _row("c", 5, "e5", "y", "m"),                 # tie on time: key decides
        _row("d", 1, "e7", "s", "m", None, "start"), _row("d", 2, "e8"),            # struct with NULL campaign
        _row(None, 3, "e9", "n", "m", user=None), _row(None, 1, "e10", user="v"),   # NULL keys fold together
    ]
    got = _run(spark, rows)
    assert got["a"] == (None, ("google", "organic", None, None))
    assert got["b"] == (None, None)
    assert got["c"] == (("y", "m", None, None), ("x", "m", None, None))
    assert got["d"] == (("s", "m", None, "start"), ("s", "m", None, "start"))
    assert got[None] == (None, ("n", "m", None, None))


def test_against_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        sk = rnd.choice(["s1", "s2", "s3", "s4", None])
        src = rnd.choice([None, None, "g", "b"])
        med = rnd.choice([None, "cpc"]) if src is None else rnd.choice(["cpc", "organic", None])
        rows.append(_row(sk, rnd.randint(0, 40), f"k{rnd.randint(0, 30):02d}", src, med, rnd.choice([None, "c1"]),
                         rnd.choice([None, "start"])))
    got = _run(spark, rows)

    def key(r):  # event time, event key, then the traffic values, NULLs first
        return (r[3], r[16] is not None, r[16] or "", *[(v is not None, v or "") for v in (r[13], r[14], r[15], r[5])])

    def struct(r):
        return (r[13], r[14], r[15], r[5]) if (r[13] is not None or r[14] is not None) else None

    for sk in {r[1] for r in rows}:
        rs = sorted((r for r in rows if r[1] == sk), key=key)
        first = struct(rs[0])
        nonnull = [struct(r) for r in rs if struct(r) is not None]
        assert got[sk] == (first, nonnull[-1] if nonnull else None), sk
