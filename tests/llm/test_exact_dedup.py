import hashlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import corpus
from touchpath.llm import exact_dedup
from touchpath.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(text):
    return hashlib.sha256((text or "").translate(LOW).encode()).digest()


def brute(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(digest(text), []).append(doc_id)
    return {d: (max((i for i in ids if i is not None), default=None), len(ids)) for d, ids in groups.items()}


@pytest.mark.parametrize("history", [None, "true", "false", "doc_id % 3 = 0"])
def test_groups_equal_brute_force(docs, history):
    out = exact_dedup.exact_duplicates(docs, history and F.expr(history)).collect()
    want = brute(corpus())
    assert len(out) == len(corpus())
    kept = [r for r in out if r["kept"]]
    assert sorted(bytes(r["digest"]) for r in kept) == sorted(want)
    for r in out:
        assert (r["keep_id"], r["group_size"]) == want[bytes(r["digest"])]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]


def test_query_and_empty_table(spark, table):
    out = QUERIES["op10_exact_dedup"](spark, table(corpus())).collect()
    assert {r["text_sha256"] for r in out} == {digest(t).hex() for _, t, *_ in corpus()}
    assert QUERIES["op10_exact_dedup"](spark, table([])).collect() == []


def test_hash_is_minimal_perfect_and_strangers_are_told_apart():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    levels, slot = exact_dedup.build_hash(keys)
    assert sorted(slot) == list(range(5000))
    assert (exact_dedup.find_slots(levels, keys) == slot).all()
    strangers = [hashlib.sha256(f"s{i}".encode()).digest() for i in range(2000)]
    stored = [k for _, k in sorted(zip(slot, keys))]
    at = exact_dedup.find_slots(levels, strangers)
    assert not any(s >= 0 and stored[s] == d for s, d in zip(at, strangers))
    assert exact_dedup.find_slots(exact_dedup.build_hash(keys[:1])[0], keys[:1])[0] == 0


def test_drop_duplicates_keeps_columns_and_one_row_each(docs, empty):
    clash = docs.withColumn("digest", F.lit(1)).withColumn("_key", F.lit("x")).withColumn("kept", F.lit(False)).withColumn("row", F.lit(2))
    out = exact_dedup.drop_duplicates(clash)
    assert out.columns == clash.columns
    rows = out.collect()
    want = brute(corpus())
    assert sorted((digest(r["text"]), r["doc_id"] or -1) for r in rows) == sorted((d, k or -1) for d, (k, _) in want.items())
    assert exact_dedup.drop_duplicates(empty).collect() == []
