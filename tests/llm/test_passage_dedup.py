import hashlib
import random
import re

import numpy as np
import pytest

from tests.llm.conftest import SCHEMA, corpus
from touchpath.llm import passage_dedup
from touchpath.llm.anchors import blocks
from touchpath.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=50):
    first = {}
    docs = [(i if i is not None else -(1 << 63), WORD.findall(t or "")) for i, t, *_ in rows]
    for i, words in docs:
        for k in range(len(words) - window + 1):
            w = tuple(words[k:k + window])
            first[w] = min(first.get(w, i), i)
    out = []
    for (doc_id, *_), (i, words) in zip(rows, docs):
        gone = np.zeros(len(words), bool)
        for k in range(len(words) - window + 1):
            if first[tuple(words[k:k + window])] < i:
                gone[k:k + window] = True
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, table):
    rows = [*corpus(), *[(500 + i, t, None, None, 0) for i, (_, t, *_) in enumerate(corpus(1, 60)) if i % 4 == 0], (700, "x " * 400, None, None, 0), (701, "x " * 90, None, None, 0)]
    want = brute(rows)
    assert sum(r[2] for r in want) > 1000
    assert got(QUERIES["op2_automaton_passages"](spark, table(rows))) == want
    assert QUERIES["op2_automaton_passages"](spark, table([])).collect() == []
    assert got(QUERIES["op2_automaton_passages"](spark, table(corpus()[:1]))) == brute(corpus()[:1])


@pytest.mark.parametrize("hot", [1, 4, 8192])
def test_hot_keys_give_the_same(spark, hot):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    shared = [f"s{i}" for i in range(47)]
    rows = []
    for i in range(60):
        own = lambda k: [f"w{rng.randrange(2)}" for _ in range(k)]  # noqa: B023, E731
        rows.append((i, " ".join(own(rng.randrange(30)) + shared + own(rng.randrange(30))), None, None, 0))
    out = passage_dedup.drop_repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(3), passage_dedup.method(hot=hot))
    want = brute(rows)
    assert sum(r[2] for r in want) > 100
    assert got(out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))) == want


def test_real_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op2_automaton_passages"](spark, folder)) == brute(rows)


def test_matching_statistics_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        auto, seen = passage_dedup.Automaton(), []
        for _ in range(rng.randrange(1, 5)):
            t = [rng.choice(b"abc") for _ in range(rng.randrange(0, 14))]
            auto.add([bytes([c]) for c in t])
            seen.append(bytes(t))
        q = bytes(rng.choice(b"abcd") for _ in range(12))
        want = [max((n for n in range(e + 2) if any(q[e + 1 - n:e + 1] in s for s in seen)), default=0) for e in range(len(q))]
        assert auto.statistics([bytes([c]) for c in q]) == want


def test_blocks_cover_each_window_once_and_depend_on_content_alone(monkeypatch):
    from touchpath.llm import anchors

    rng = np.random.default_rng(5)
    for segment in (1 << 19, 64):
        monkeypatch.setattr(anchors, "SEGMENT", segment)
        values = rng.integers(0, 1 << 62, 700).astype(np.uint64)
        values[400:560] = values[100:260]
        off = np.array([0, 30, 30, 330, 700])
        doc, first, count, key, content, lead = blocks(lambda s, e: values[s:e], off, 50, 12)
        seen = np.zeros(700, int)
        for d, f, c in zip(doc, first, count):
            at = off[d] + f
            assert at + c + 49 <= off[d + 1]
            seen[at:at + c] += 1
        for d in range(4):
            n = max(0, off[d + 1] - off[d] - 49)
            assert (seen[off[d]:off[d] + n] == 1).all() and (seen[off[d] + n:off[d + 1]] == 0).all()
        owner = {off[d] + f + i: (k, le - i) for d, f, c, k, le in zip(doc, first, count, key, lead) for i in range(c)}
        for i in range(100, 260 - 49):
            assert owner[i] == owner[i + 300]
