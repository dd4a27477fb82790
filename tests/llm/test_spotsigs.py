import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import corpus
from touchpath.llm import spotsigs
from touchpath.llm.queries import QUERIES


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text, *_) in enumerate(order):
        text, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        k = len(text) // 4
        edited = text[:len(text) - k] + nxt[:k]
        a, b, c = (set(map(int, spotsigs.signatures(t))) for t in (text, edited, nxt))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(len(a & b) / len(a | b), 9), round(len(a & c) / len(a | c), 9)))
    return sorted(out, key=str)


def got(rows):
    return sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in rows), key=str)


@pytest.mark.parametrize("each", [2000, 3, 1])
def test_successors_equal_brute_force_whatever_the_ranges(spark, each):
    from tests.llm.conftest import SCHEMA

    rows = [r for r in corpus() if r[0] is not None] + [(None, "the first one", "en", "s", 0)]
    d = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(spotsigs.beside_next(d, each).collect()) == brute(rows)


def test_query_on_odd_tables(spark, table):
    one = [(5, "the quick brown fox", "en", "s", 0)]
    assert got(QUERIES["op1_spotsigs"](spark, table(one)).collect()) == brute(one)
    assert QUERIES["op1_spotsigs"](spark, table([])).collect() == []
    out = QUERIES["op1_spotsigs"](spark, table(corpus())).collect()
    assert len(out) == len(corpus()) and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)


def test_equal_texts_equal_fingerprints_and_edits_stay_near(spark):
    folder = "/root/testdata/sf0.001"
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = {r["doc_id"]: r for r in QUERIES["op1_spotsigs"](spark, folder).collect()}
    by = {}
    for i, t in text.items():
        by.setdefault(t, set()).add(out[i]["fingerprint"])
    assert all(len(f) == 1 for f in by.values())
    long = [r for r in out.values() if r["n_chars"] > 1000]
    assert np.mean([r["near_edited"] for r in long]) > 0.4 > 0.1 > np.median([r["near_next"] for r in long])


def test_signatures():
    sig = lambda t: list(map(int, spotsigs.signatures(t)))
    assert sig("The quick brown fox") == sig("the, Quick BROWN -- dog!")
    assert len(sig("the quick brown fox and lazy dogs")) == 2
    assert sig(None) == sig("") == sig(" \n") != sig("word")
    assert len(sig("no spots here")) == 1 and sig("no spots here") != sig("no spots there")


@pytest.mark.parametrize("text", [
    " ".join(f"| sor{i} {i * 7} érték{i}" for i in range(40)),
    "jedna dva tři čtyři pět šest sedm osm devět deset jedenáct dvanáct",
    "".join(chr(0x4E00 + i * 37 % 5000) for i in range(120)),
])
def test_edited_texts_without_anchors_stay_near(spark, text):
    following = "the start of a text and of its many words, which the next one is " * 9
    d = spark.createDataFrame([(1, text), (2, following)], "doc_id long, text string")
    first = next(r for r in spotsigs.beside_next(d).collect() if r["doc_id"] == 1)
    assert first["near_edited"] > 0.4 and first["near_next"] == 0
    # also beside another text of the kind
    a, b = (spotsigs.signatures(t) for t in (text, spotsigs.edit(text, text[::-1])))
    assert spotsigs.likeness(a, b) > 0.4


def test_near_pairs_equal_brute_force(spark):
    rows = [(i, t) for i, t, *_ in corpus(5, 120) if i is not None]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spots", F.lit(1)).withColumn("class", F.lit(2))
    members, pairs = spotsigs.near_pairs(d)
    cls = {}
    for r in members.collect():
        cls.setdefault(r["class"], set()).add(r["doc_id"])
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(map(int, spotsigs.signatures(t))), set()).add(i)
    assert {min(v): v for v in sets.values()} == cls
    names = {min(v): k for k, v in sets.items()}
    want = {frozenset((a, b)) for a in names for b in names if a < b and len(names[a] & names[b]) >= 0.8 * len(names[a] | names[b])}
    found = [frozenset((r["a"], r["b"])) for r in pairs.collect()]
    assert sorted(map(sorted, found)) == sorted(map(sorted, want)) and want


def test_classes_without_a_doc_id_are_paired_too(spark):
    a = corpus(5, 20)[10][1] or "the quick brown fox jumps over the lazy dog of the house " * 4
    rows = [(None, a), (None, a), (None, a + " of other words"), (7, "the house of cards and the men of straw")]
    members, pairs = spotsigs.near_pairs(spark.createDataFrame(rows, "doc_id long, text string"), 0.3)
    members = members.collect()
    assert len(members) == 4 and all(r["class"] is not None for r in members) and {r["class"] for r in members if r["doc_id"]} == {7}
    unnamed = {r["class"] for r in members if r["doc_id"] is None}
    assert len(unnamed) == 2 and max(unnamed) < 0
    assert {frozenset((r["a"], r["b"])) for r in pairs.collect()} >= {frozenset(unnamed)}
