import math
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, corpus
from touchpath.llm import common, mixing
from touchpath.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def goals(sizes):
    """Reshare rounds, literally: cap what is over, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


def rates(sizes, target):
    """One source's rates by bisection."""
    m = sum(sizes) / len(sizes)
    f = lambda lam: sum(x * math.exp(min(lam * x / m, math.log(3))) for x in sizes) - target
    lo, hi = -1e4, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return [math.exp(min(lo * x / m, math.log(3))) for x in sizes]


def check(rows, out):
    size = {}
    for _, text, _, source, _ in rows:
        size.setdefault(source, []).append(len(WORD.findall(text or "")))
    want = goals({s: sum(v) for s, v in size.items()})
    assert len(out) == len(rows)
    for source, sizes in size.items():
        own = [r for r in out if r["source"] == source]
        assert sorted(r["size"] for r in own) == sorted(sizes)
        assert all(r["source_size"] == sum(sizes) and abs(r["target"] - want[source]) <= 1e-6 * max(1, want[source]) for r in own)
        assert all(0 <= r["copies"] <= 3 for r in own)
        assert abs(sum(r["taken"] for r in own) - want[source]) <= max(sizes) + 1
        if 0 < want[source] < 3 * sum(sizes):
            by_size = {}
            for x, r in zip(sizes, rates(sizes, want[source])):
                by_size[x] = r
            for r in own:
                if r["size"]:
                    assert math.floor(by_size[r["size"]] - 1e-6) <= r["copies"] <= math.ceil(by_size[r["size"]] + 1e-6)


def test_query_equals_brute_force_and_reruns_agree(spark, table):
    folder = table(corpus())
    out = QUERIES["op9_entropy_mixing"](spark, folder).collect()
    check(corpus(), out)
    again = QUERIES["op9_entropy_mixing"](spark, folder).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert QUERIES["op9_entropy_mixing"](spark, table([])).collect() == []


def test_capped_sources_and_one_hot_source(spark, table):
    rows = [(i, "w " * (i % 50 + 1), None, "a" if i % 40 else ["b", "c", "d", None][i // 40 % 4], 0) for i in range(800)]
    out = QUERIES["op9_entropy_mixing"](spark, table(rows)).collect()
    check(rows, out)
    assert any(r["target"] == 3 * r["source_size"] for r in out)


def test_clashing_columns_and_textless_sources(spark, docs):
    d = docs.withColumn("size", common.count_words("text")).withColumn("_cut", F.lit(1)).withColumn("target", F.lit("x")).withColumn("n", F.lit(0)).withColumn("row", F.lit(3))
    out = mixing.mix(d)
    assert out.columns == [*[c for c in d.columns if c != "target"], "source_size", "target", "copies"]
    assert out.count() == d.count()
    none = spark.createDataFrame([(1, "s", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert [r["target"] for r in mixing.mix(none).collect()] == [0.0, 0.0]


def test_a_null_is_no_value_of_its_own_name(spark):
    """Rows that differ in a null alone are documents each."""
    rows = [(k, "t u v", None, s, 5) for k in (*range(10), None, -(1 << 63)) for s in (None, "~", "", "s")]
    rows += [(2, None, None, "s", 0), (2, "", None, "s", 0), rows[0]]
    out = mixing.resample(spark.createDataFrame(rows, SCHEMA)).collect()
    sized = mixing.mix(spark.createDataFrame(rows, SCHEMA).withColumn("size", common.count_words("text"))).collect()
    from collections import Counter
    want = Counter()
    for r in sized:
        want[r["source"], r["text"] is None, r["text"]] += r["copies"]
    assert Counter((r["source"], r["text"] is None, r["text"]) for r in out) == +want
    assert {None, "~", ""} <= {s for s, *_ in +want}


def test_an_unsolved_dual_raises(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    rows = [(i, "w " * (i + 1), None, "ab"[i % 2], 0) for i in range(20)]
    with pytest.raises(RuntimeError, match="not solved"):
        mixing.mix(spark.createDataFrame(rows, SCHEMA).withColumn("size", common.count_words("text"))).collect()
