import os
import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import test_exact_dedup, test_minhash, test_mixing, test_packing
from tests.llm.conftest import corpus
from touchpath.llm import common, exact_dedup
from touchpath.session import checkpoint_root

STAGE = dict(corpus_pipeline.STAGES)


def clashing(docs):
    for c in ("row", "size", "score", "rejected", "copies", "target", "_id", "_key", "doc_text", "kept", "col"):
        docs = docs.withColumn(c, F.lit("x"))
    return docs


def test_stages_are_the_dealt_ones_and_keep_all_columns(spark, docs, empty):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]
    d = clashing(docs)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, "")
        assert out.columns == d.columns and dict(out.dtypes) == dict(d.dtypes)
        assert out.count() > 0
        assert stage(spark, empty, "").collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, empty, "").collect() == []


def test_language_stage_drops_only_what_has_no_language(spark, docs):
    rows = STAGE["language_id"](spark, docs, "").collect()
    lettered = [r for r in corpus() if any(c.isalpha() for c in r[1] or "")]
    assert not {r["text"] for r in rows} - {r[1] for r in lettered}
    long = Counter((r[0], r[1]) for r in lettered if len(r[1]) > 300)
    kept = Counter((r["doc_id"], r["text"]) for r in rows if len(r["text"]) > 300)
    assert sum((long - kept).values()) <= 0.1 * sum(long.values())


def test_exact_stage_equals_brute_force(spark, docs):
    rows = STAGE["exact_dedup"](spark, docs, "").collect()
    want = test_exact_dedup.brute(corpus())
    assert sorted((test_exact_dedup.digest(r["text"]), r["doc_id"] or -1) for r in rows) == sorted((d, k or -1) for d, (k, _) in want.items())


def test_near_stage_equals_brute_force(spark):
    from tests.llm.conftest import SCHEMA

    rows = [r for r in corpus(2, 150) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    out = STAGE["near_dedup"](spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect()
    want = {d for d, n, c in test_minhash.brute(rows, 5) if d == c}
    assert sorted(r["doc_id"] for r in out) == sorted(want)


def test_near_stage_on_repeated_and_null_ids(spark, docs):
    out = STAGE["near_dedup"](spark, docs, "").collect()
    want = test_minhash.brute(corpus(), 5)
    linked = {c for _, n, c in want if n}
    assert len([r for r in out if test_minhash.shingles(r["text"], 5)]) <= len(linked) + 1
    assert len({(r["doc_id"], r["text"]) for r in out}) == len(out)


def test_mixing_stage_reaches_the_targets(spark, docs):
    rows = list({(r[0], r[1], r[3]): r for r in corpus()}.values())
    size = lambda t: len(test_mixing.WORD.findall(t or ""))
    have = {}
    for _, t, _, source, _ in corpus():
        have.setdefault(source, []).append(size(t))
    want = test_mixing.goals({s: sum(v) for s, v in have.items()})
    out = STAGE["mixing"](spark, docs, "").collect()
    got = Counter()
    for r in out:
        got[r["source"]] += size(r["text"])
    assert all(abs(got[s] - want[s]) <= max(have[s]) + 1 for s in have)
    times = Counter((r["doc_id"], r["text"], r["source"]) for r in out)
    copies = Counter((r[0], r[1], r[3]) for r in corpus())
    assert all(n <= 3 * copies[k] for k, n in times.items()) and set(times) <= {(r[0], r[1], r[3]) for r in rows}


def test_run_on_a_real_table(spark):
    folder = "/root/testdata/sf0.001"
    # an unrelated result that is not asked for yet keeps its tables
    lazy = exact_dedup.exact_duplicates(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
    top = f"{checkpoint_root(spark)}/touchpath".removeprefix("file:")
    before = set(os.listdir(top))
    out = corpus_pipeline.run(spark, folder).collect()
    assert lazy.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    # the last stage's input and its own tables alone are left
    assert all(re.match("(mixing|pieces)-", p) for p in set(os.listdir(top)) - before)
    test_packing.held(out)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = {r["doc_id"] for r in out}
    assert ids <= set(texts) and len({test_exact_dedup.digest(texts[i]) for i in ids}) == len(ids)
    whole = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out]
    rows = []
    for i, n in Counter(r["doc_id"] for r in out if r["piece"] == 0).items():
        rows += [(i, texts[i])] * n
    test_packing.check(rows, out)
    assert len(whole) == len(out)


def test_scopes_delete_their_own_tables(spark):
    top = f"{checkpoint_root(spark)}/touchpath".removeprefix("file:")
    outside = common.stash(spark.range(3), "t-outside")
    with common.scratch(spark):
        outer = common.stash(spark.range(4), "t-outer")
        with common.scratch(spark):
            common.stash(spark.range(5), "t-inner")
            made, path = common.written(spark.range(6), "t-made")
        assert outer.count() == 4 and made.count() == 6
        assert not [d for d in os.listdir(top) if d.startswith("t-inner")]
    assert not [d for d in os.listdir(top) if d.startswith("t-outer")] and outside.count() == 3 and made.count() == 6
    try:
        with common.scratch(spark):
            common.stash(spark.range(1), "t-failed")
            raise KeyError
    except KeyError:
        pass
    assert not [d for d in os.listdir(top) if d.startswith("t-failed")] and common._SCOPES == []
