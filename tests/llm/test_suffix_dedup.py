import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, corpus
from touchpath.llm import suffix_dedup
from touchpath.llm.queries import QUERIES
from touchpath.llm.repeats import Block


def brute(rows, window=200):
    count = {}
    docs = [(t or "").encode() for _, t, *_ in rows]
    for d in docs:
        for k in range(len(d) - window + 1):
            w = d[k:k + window]
            count[w] = count.get(w, 0) + 1
    out = []
    for (doc_id, *_), d in zip(rows, docs):
        gone = np.zeros(len(d) + 2, bool)
        for k in range(len(d) - window + 1):
            if count[d[k:k + window]] > 1:
                gone[k + 1:k + 1 + window] = True
        kept = bytes(c for c, g in zip(d, gone[1:-1]) if not g)
        out.append((doc_id, len(d), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, table):
    rows = corpus()
    want = brute(rows)
    assert sum(r[2] for r in want) > 5000 and any(0 < r[2] < r[1] for r in want)
    assert got(QUERIES["op8_suffix_sort"](spark, table(rows))) == want
    assert QUERIES["op8_suffix_sort"](spark, table([])).collect() == []
    one = [(1, "q" * 205 + "é" * 150, None, None, 0)]
    assert got(QUERIES["op8_suffix_sort"](spark, table(one))) == brute(one)


@pytest.mark.parametrize("hot", [1, 5, 2048])
def test_hot_keys_give_the_same(spark, hot):
    rng = random.Random(3)
    shared = "".join(rng.choice("abcdefgh") for _ in range(196))
    own = lambda: "".join(rng.choice("01") for _ in range(rng.randrange(60)))
    rows = [(i, own() + shared + own(), None, None, 0) for i in range(60)]
    out = suffix_dedup.drop_repeated_bytes(spark.createDataFrame(rows, SCHEMA).repartition(3), suffix_dedup.method(hot=hot))
    want = brute(rows)
    assert sum(r[2] for r in want) > 200
    assert got(out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))) == want


def test_real_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op8_suffix_sort"](spark, folder)) == brute(rows)


def test_merge_sort_is_a_sort_of_suffixes():
    rng = np.random.default_rng(1)
    for _ in range(20):
        text = rng.integers(97, 99, 400).astype(np.uint8)
        order = suffix_dedup.Suffixes(text, 30)
        starts = rng.permutation(np.arange(300))
        cuts = np.sort(rng.choice(np.arange(1, 300), 4, replace=False))
        size = np.diff([0, *cuts, 300])
        first, length = np.repeat([0, *cuts], size), np.repeat(size, size)
        done = suffix_dedup.merge_sort(starts, first, length, order)
        raw = text.tobytes()
        for a, b in zip([0, *cuts], [*cuts, 300]):
            assert sorted(done[a:b]) == sorted(starts[a:b])
            keys = [raw[s:s + 30] for s in done[a:b]]
            assert keys == sorted(keys)


def test_collisions_are_told_and_sorted_again(monkeypatch):
    # under the first hashes all strings are equal; the bytes tell, and others are used
    real = suffix_dedup.byte_values
    monkeypatch.setattr(suffix_dedup, "byte_values", lambda seed=0: np.zeros(256, np.uint64) if seed == 0 else real(seed))
    group = [Block(1, k, k, 0, 1, data) for k, data in enumerate([b"ab" * 100, b"ba" * 100, b"ab" * 100])]
    assert [m.tolist() for m in suffix_dedup.judge(group, 200)] == [[True], [False], [True]]
