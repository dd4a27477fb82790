import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, corpus
from touchpath.llm import common, minhash
from touchpath.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LEAST = -(1 << 63)


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOW))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute(rows, k=2):
    sets = [shingles(t, k) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    seen = set()
    for ids in by.values():
        for i in ids:
            for j in ids:
                if i < j and (i, j) not in seen:
                    seen.add((i, j))
                    if len(sets[i] & sets[j]) * 100 >= 80 * len(sets[i] | sets[j]):
                        root[find(i)] = find(j)
    low = {}
    for i, (doc_id, *_) in enumerate(rows):
        at = LEAST if doc_id is None else doc_id
        low[find(i)] = min(low.get(find(i), at), at)
    return sorted(((d, len(sets[i]), None if low[find(i)] == LEAST else low[find(i)]) for i, (d, *_) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, table):
    rows = corpus(2, 150)
    want = brute(rows)
    assert len({r[2] for r in want}) < len(rows) - 20
    out = QUERIES["op4_minhash_hamming"](spark, table(rows))
    assert got(out) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out.collect())
    assert QUERIES["op4_minhash_hamming"](spark, table([])).collect() == []


@pytest.mark.parametrize(("stars", "large"), [(0, 64), (0, 1), (1, 64), (4, 1)])
def test_chains_and_hot_groups_whatever_the_rounds(spark, monkeypatch, stars, large):
    monkeypatch.setattr(minhash, "STARS", stars)
    monkeypatch.setattr(minhash, "LARGE", large)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):  # a chain: each text is near the one before, far from the first
        words = list(base)
        for k in range(i):
            words[k] = f"n{k}"
        rows.append((100 - i, " ".join(words), None, None, 0))
    rows += [(200 + i, " ".join(base[:50] + [f"x{i}"] * 3), None, None, 0) for i in range(40)]
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(minhash.link_components(d, 2)) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_large_buckets_lose_no_link_near_the_threshold(spark, monkeypatch, seed):
    """Texts that derive from one template by a few changes, some of them shared;
    similarities lie around the threshold, and no stars help."""
    monkeypatch.setattr(minhash, "STARS", 0)
    monkeypatch.setattr(minhash, "LARGE", 1)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(120):
        words = list(base)
        for k in rng.choice(80, rng.integers(1, 9), replace=False):
            words[k] = f"c{rng.integers(0, 4)}_{k}"
        rows.append((i, " ".join(words[:80 - int(rng.integers(0, 12))]), None, None, 0))
    want = brute(rows)
    assert 1 < len({r[2] for r in want}) < 120
    assert got(minhash.link_components(spark.createDataFrame(rows, SCHEMA).repartition(3), 2)) == want


def test_real_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op4_minhash_hamming"](spark, folder)) == brute(rows)


def test_pairs_within_the_distance_share_a_key():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 1 << 14, 32).astype(np.uint16)
        b = a.copy()
        at = rng.choice(32, 15, replace=False)
        b[at] ^= 1
        assert set(minhash.chunk_keys(a)) & set(minhash.chunk_keys(b))


def test_sketches_never_differ_in_more_bits_than_sets_in_shingles(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(200):
        both = rng.integers(0, 1 << 62, rng.integers(0, 900)).astype(np.uint64)
        only = [rng.integers(0, 1 << 62, rng.integers(0, 300 if i % 2 else 6)).astype(np.uint64) for _ in "ab"]
        a, b = (np.unique(np.concatenate([both, x])) for x in only)
        if len(a) and len(b):
            rows.append((len(np.setxor1d(a, b)), minhash.sketch(a), minhash.sketch(b)))
    got = spark.createDataFrame(rows, "k int, a array<long>, b array<long>").select("k", minhash.unlike("a", "b").alias("d")).collect()
    assert len(got) > 150 and all(r["d"] <= r["k"] and r["d"] % 2 == r["k"] % 2 for r in got)
    few = [r for r in got if r["k"] <= 12]
    assert few and sum(r["d"] == r["k"] for r in few) > 0.8 * len(few)


def test_links_of_far_signatures_are_kept(spark):
    """Linked texts whose signatures differ in many values, but that share a key."""
    rng = random.Random(11)
    found = 0
    for _ in range(4000):
        base = [f"w{rng.randrange(10**6)}" for _ in range(48)]
        other = list(base)
        for i in rng.sample(range(5, 44, 8), 2):
            other[i] = f"x{rng.randrange(10**6)}"
        a, b = (" ".join(x) for x in (base, other))
        sets = [next(minhash.shingle_sets(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), 2)) for t in (a, b)]
        both = len(np.intersect1d(*sets))
        if 100 * both < 80 * (len(sets[0]) + len(sets[1]) - both):
            continue
        sigs = [minhash.signature(x) for x in sets]
        if (sigs[0] != sigs[1]).sum() >= 13 and set(minhash.chunk_keys(sigs[0])) & set(minhash.chunk_keys(sigs[1])):
            found += 1
            out = minhash.link_components(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string"), 2).collect()
            assert {r["component_id"] for r in out} == {1}
            if found == 2:
                break
    assert found


def test_components_of_edges(spark):
    edges = [(1, 2), (2, 3), (9, 3), (5, 6), (7, 7), (20, 10), (10, 30), (30, 40), (40, 50), (50, 60)]
    out = common.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()
    assert {r["node"]: r["component"] for r in out} == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5, 10: 10, 20: 10, 30: 10, 40: 10, 50: 10, 60: 10}
    assert common.components(spark.createDataFrame([], "a long, b long"), "t").collect() == []
