import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import SCHEMA, corpus
from touchpath.llm import lexical_packing as L
from touchpath.llm.queries import QUERIES

ODD = ["<|endoftext|> x", "a<|endoftext|>b <|endoftext|><|endoftext|>  ", "   tab\t\r\n", "a" * 3000, "é" * 700, "😀👍🏽" * 50, "it's we'LL they've", "\x00\x01", "word " * 5000]


def check(rows, out, capacity=1024):
    """Every id in one piece; sequences without gaps or padding."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for doc_id, text, *_ in rows:
        want[doc_id, tuple([*tok.encode(text or "", add_special_tokens=False).ids, 0])] += 1
    texts = {}
    for (doc_id, ids), n in want.items():
        texts.setdefault((doc_id, len(ids)), []).extend([ids] * n)
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces.keys() == texts.keys()
    for key, mine in pieces.items():
        crc = lambda ids, r: zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
        cover = Counter()
        for r in mine:
            assert any(crc(ids, r) == r["ids_crc32"] for ids in texts[key])
            cover.update(range(r["start"], r["start"] + r["length"]))
        assert cover == Counter({i: len(texts[key]) for i in range(key[1])})
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at and n > 0
            at += n
        assert at == capacity or (at < capacity and at & (at - 1) == 0)
    return sequences


def test_query_keeps_every_id_and_needs_no_padding(spark, table):
    rows = corpus() + [(1000 + i, t, None, None, 0) for i, t in enumerate(ODD)]
    out = QUERIES["op12_lexical_packing"](spark, table(rows)).collect()
    check(rows, out)
    assert QUERIES["op12_lexical_packing"](spark, table([])).collect() == []


def test_real_texts(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    first = QUERIES["op12_lexical_packing"](spark, folder).collect()
    check(rows, first)
    assert sorted(first) == sorted(QUERIES["op12_lexical_packing"](spark, folder).collect())


def test_clashing_columns_and_ranges(spark):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns({c: F.lit(1) for c in ("ids", "df", "t0", "start")})
    check(rows, L.pack_documents(docs).collect())


def bm25(query, docs, df, n, mean):
    """Scores from the formula, document by document."""
    out = []
    for d in docs:
        tf = Counter(d[:-1].tolist())
        s = 0.0
        for t in query:
            idf = max(0.0, math.log((n - df[t] + 0.5) / (df[t] + 0.5)))
            if tf[t] and df[t] > 1:
                s += idf * tf[t] * (L.K1 + 1) / (tf[t] + L.K1 * (1 - L.B + L.B * (len(d) - 1) / mean))
        out.append(s)
    return out


def small_corpus(seed, n=60):
    rng = random.Random(seed)
    return [np.array([rng.choice(range(1 + 20 * (i % 5), 40 + 20 * (i % 5))) for _ in range(rng.randrange(0, 50))] + [0], "<u2") for i in range(n)]


def stats_of(docs):
    df = np.zeros(L.VOCABULARY, np.int64)
    for d in docs:
        df[np.unique(d[:-1].astype(int))] += 1
    df[df == 1] = 0
    mean = float(np.mean([len(d) - 1 for d in docs]))
    return df, L.Statistics(df, len(docs), mean), mean


def test_index_scores_are_bm25():
    docs = small_corpus(1)
    df, stats, mean = stats_of(docs)
    index = L.Shard(docs, stats)
    for i in (0, 7, 33):
        np.testing.assert_allclose(index.scores(index.own[i]), bm25(set(docs[i][:-1].tolist()), docs, df, len(docs), mean), rtol=1e-9)


def test_windows_hold_the_best_unused_neighbours():
    docs = small_corpus(2)
    df, stats, mean = stats_of(docs)
    cap, windows = 100, L.Windows(100)
    sequences = windows.add(0, docs, stats) + windows.close()
    used, opener = set(), None
    for seq in sequences[:-8]:
        (seed, _, n), *others = seq
        used.add(seed)
        score = bm25(set(docs[seed][:-1].tolist()), docs, df, len(docs), mean)
        room = cap - n
        for doc, start, took in others:
            left = [i for i in range(len(docs)) if i not in used]
            fit = [i for i in left if len(docs[i]) <= room] or left
            best = max(score[i] for i in fit)
            assert start == 0 and abs(score[doc] - best) < 1e-9
            used.add(doc)
            room -= took
        assert room == 0
        opener = others[-1][0] if others and sum(others[-1][1:]) < len(docs[others[-1][0]]) else None
        if opener is not None:
            nxt = sequences[sequences.index(seq) + 1]
            assert nxt[0][0] == opener


def test_many_shards_lose_nothing():
    docs = [(i, 100 + len(d), 100, d) for i, d in enumerate(small_corpus(3, 200))]
    _, stats, _ = stats_of([d for *_, d in docs])
    out = list(L.pack_range(iter(docs), stats, 3, capacity=64, shard_docs=7))
    cover = Counter()
    for doc_id, start, n, crc, total, seq, _ in out:
        ids = docs[doc_id][3]
        assert total == 100 + len(ids) and crc == zlib.crc32(ids[start - 100:start - 100 + n].astype("<u4").tobytes()) and seq >> 40 == 3
        cover.update((doc_id, i) for i in range(start, start + n))
    assert set(cover.values()) == {1} and len(cover) == sum(len(d) for *_, d in docs)


def test_powers_of_two():
    for pieces in ([], [(0, 5, 1)], [(0, 0, 700), (1, 3, 323)], [(0, 0, 512)]):
        out = list(L.powers(pieces))
        assert [sum(n for *_, n in s) for s in out] == [1 << b for b in range(10, -1, -1) if sum(n for *_, n in pieces) >> b & 1]
        flat = [(d, i) for s in out for d, a, n in s for i in range(a, a + n)]
        assert flat == [(d, i) for d, a, n in pieces for i in range(a, a + n)]


def test_related_documents_share_windows():
    rng = random.Random(9)
    topics = [[rng.randrange(1000 * k + 1000, 1000 * k + 1100) for _ in range(60)] for k in range(10)]
    docs = [np.array([rng.choice(topics[i % 10]) for _ in range(40)] + [0], "<u2") for i in range(300)]
    _, stats, _ = stats_of(docs)
    windows = L.Windows(256)
    sequences = windows.add(0, docs, stats)
    same = sum(d % 10 == s[0][0] % 10 for s in sequences for d, *_ in s[1:])
    assert same > 0.8 * sum(len(s) - 1 for s in sequences)
