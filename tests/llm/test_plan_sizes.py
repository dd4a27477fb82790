"""Plans stay small: the driver holds each of them, and anew at each of its stages."""

import random
import tracemalloc

from pyspark.sql import functions as F

from touchpath.llm import common, minhash, mixing, packing


def joins(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def recorded(monkeypatch, module):
    """Joins of each table that ``module`` writes, by its name."""
    seen = []

    def stash(df, name, *args, **more):
        seen.append((name, joins(df)))
        return common.stash(df, name, *args, **more)

    monkeypatch.setattr(module, "stash", stash)
    return seen


def test_a_step_of_the_dual_joins_once(docs, monkeypatch):
    seen = recorded(monkeypatch, mixing)
    counts = docs.select("source", F.length(F.coalesce("text", F.lit(""))).alias("size")).groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    mixing.balance(counts, mixing.targets(counts)).count()
    steps = [n for name, n in seen if name == "dual"][1:]
    assert steps and max(steps) == 1


def test_near_dedup_names_components_once(docs):
    # once 16 joins: each branch of the result named the components again
    assert joins(minhash.link_components(docs.select("doc_id", "text"))) <= 6


def test_no_components_anew_without_new_links(docs, monkeypatch):
    calls = []

    def components(*args):
        calls.append(args)
        return common.components(*args)

    monkeypatch.setattr(minhash, "components", components)
    one = docs.where("text IS NOT NULL").select("doc_id", "text").limit(1)
    assert minhash.link_components(one).count() == 1
    assert len(calls) == minhash.STARS


def test_a_round_of_components_reads_each_edge_once_a_side(spark, monkeypatch):
    # once 8 reads and 6 aggregates a round: both directions of each edge, and a further distinct
    seen, stash = [], common.stash

    def recorded(df, *args, **more):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        seen.append((plan.count("Relation"), plan.count("Aggregate")))
        return stash(df, *args, **more)

    monkeypatch.setattr(common, "stash", recorded)
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    out = common.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()
    assert len(seen) > 1 and all(reads <= 4 and aggregates <= 4 for reads, aggregates in seen[1:])
    least = list(range(200))
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert {(r["node"], r["component"]) for r in out} == {(x, least[x]) for a, b in edges if a != b for x in (a, b)}


def test_the_first_stars_join_no_empty_tables(docs, monkeypatch):
    seen = recorded(monkeypatch, minhash)
    minhash.link_components(docs.select("doc_id", "text")).count()
    # of once 8: three times the labels of no component, and the pairs of no star before
    assert next(n for name, n in seen if name == "pairs") == 4


def test_the_packing_search_keeps_little_of_an_open_node():
    rng = random.Random(3)
    counts = {x: rng.randrange(1, 60) for x in range(1, 1025)}
    tracemalloc.start()
    try:
        packing.bin_completion(counts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 60e6, peak  # once 110 MB and more, which the driver kept
