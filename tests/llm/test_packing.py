import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import corpus
from touchpath.llm import packing
from touchpath.llm.queries import QUERIES


def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, out):
    tok = reference()
    want = []
    for doc_id, text, *_ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        head = len(ids) % 1024 or 1024
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((doc_id or -1, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == sorted(want)
    held(out)


def held(out):
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by)


ODD = ["<|endoftext|> x", "a <|endoftext|> b<|endoftext|>", "   tab\t\r\n", "a" * 3000, "é" * 700, "😀👍🏽" * 50, "﻿ bom", "١٢٣ ½", "it's we'LL they've", "\x00\x01", "ab‍cd  "]


def test_query_equals_tokenizer_and_packs_without_gaps(spark, table):
    rows = corpus() + [(1000 + i, t, None, None, 0) for i, t in enumerate(ODD)]
    out = QUERIES["op7_best_fit_packing"](spark, table(rows)).collect()
    check(rows, out)
    assert QUERIES["op7_best_fit_packing"](spark, table([])).collect() == []


def test_real_texts_have_the_tokenizers_ids(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = QUERIES["op7_best_fit_packing"](spark, folder).collect()
    check(rows, out)
    n = len({r["sequence_id"] for r in out})
    assert n <= -(-sum(r["length"] for r in out) // 1024) + 2


@pytest.mark.parametrize("seed", range(12))
def test_bin_completion_against_optimum(seed):
    rng = random.Random(seed)
    cap = 40
    counts = {}
    for _ in range(rng.randrange(5, 11)):
        x = rng.randrange(3, cap + 1)
        counts[x] = counts.get(x, 0) + 1
    items = sorted((x for x, n in counts.items() for _ in range(n)), reverse=True)

    def optimum():
        best = len(items)

        def go(i, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if i == len(items):
                best = len(bins)
                return
            for b in sorted(set(bins)):
                if b >= items[i]:
                    k = bins.index(b)
                    go(i + 1, [*bins[:k], b - items[i], *bins[k + 1:]])
            go(i + 1, [*bins, cap - items[i]])

        go(0, [])
        return best

    got = packing.bin_completion(counts, cap)
    assert sorted((x for p, n in got for x in p for _ in range(n)), reverse=True) == items
    assert all(sum(p) <= cap for p, _ in got)
    assert sum(n for _, n in got) == optimum()


def test_equal_sums_are_all_tried():
    lengths = [600, 500, 450, 450, 300, 250, 224, 174, 124]
    got = packing.bin_completion({x: lengths.count(x) for x in lengths})
    assert sum(n for _, n in got) == 3
    assert sorted(x for p, n in got for x in p * n) == sorted(lengths)


@pytest.mark.parametrize("seed", range(40))
def test_fillings_are_the_undominated_ones(seed):
    rng = random.Random(seed)
    counts = {x: rng.randrange(1, 4) for x in rng.sample(range(2, 26), rng.randrange(1, 7))}
    order, space = sorted(counts, reverse=True), 30
    every = [()]
    for x in order:
        every = [(*f, *[x] * k) for f in every for k in range(counts[x] + 1) if sum(f) + k * x <= space]

    def dominated(f):
        spare, free = space - sum(f), [x for x in order if f.count(x) < counts[x]]
        parts = [part for k in range(len(f) + 1) for part in itertools.combinations(f, k)]
        return any(sum(p) <= x <= sum(p) + spare and p != (x,) for p in parts for x in free)

    want = [f for f in every if not dominated(f)]
    got = [f for f in packing.fillings(order, counts, space, space) if f is not None]
    assert sorted(got) == sorted(want)
    assert [sum(f) for f in got] == sorted(map(sum, got), reverse=True)


def test_large_histogram_is_near_its_lower_bound():
    rng = random.Random(3)
    counts = {x: rng.randrange(0, 4000) for x in range(1, 1025)}
    got = packing.bin_completion(counts)
    total = sum(x * n for x, n in counts.items())
    packed = {}
    for p, n in got:
        for x in p:
            packed[x] = packed.get(x, 0) + n
    assert packed == {x: n for x, n in counts.items() if n}
    lower = max(-(-total // 1024), sum(n for x, n in counts.items() if x > 512))
    assert sum(n for _, n in got) <= lower * 1.002 + 1


def test_payload_and_clashing_columns(spark):
    pieces = spark.createDataFrame([(1, 0, 1000), (1, 1, 24), (2, 0, 500), (None, 0, 500), (2, 0, 500)], "doc_id long, piece int, length long")
    pieces = pieces.withColumn("no", F.lit("p")).withColumn("row", F.lit(1)).withColumn("offset", F.lit(-1))
    out = packing.pack(pieces)
    assert out.columns == ["doc_id", "piece", "length", "no", "row", "sequence_id", "offset"]
    assert held(out.collect()) == 3
