"""Passage dedup by suffix automata: every word covered by a window of
``window`` words that also starts in an earlier document is removed.

The reference of a document is everything earlier.  It is cut into shards by
content: a shard holds the blocks (see ``anchors``, ``repeats``) of a key that
are distinct from each other, and meets just the blocks that can match it.  In a
shard, blocks stream in the order of their documents: each is run through the
suffix automaton of the ones before it, whose matching statistics (the longest
match that ends at each word) tell the windows found earlier; then it extends
the automaton.

Defined results: null and empty texts have no words; a null doc_id ranks below
all others; rows that share a doc_id are one document, whose windows do not
match each other; words are compared unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchpath.llm.common import word_bounds, word_hashes
from touchpath.llm.repeats import Block, Method, covered, with_ranges

WINDOW = 50
GRAM = 12


class Automaton:
    """Suffix automaton of token sequences, grown online; sequences are kept
    apart by tokens that occur nowhere else."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.last, self.sequences = 0, 0

    def _extend(self, token) -> None:
        nxt, link, length = self.next, self.link, self.length
        cur = len(length)
        nxt.append({})
        link.append(0)
        length.append(length[self.last] + 1)
        p = self.last
        while p >= 0 and token not in nxt[p]:
            nxt[p][token] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][token]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(length)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(token) == q:
                    nxt[p][token] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        self.last = cur

    def add(self, tokens: list) -> None:
        for t in tokens:
            self._extend(t)
        self.sequences += 1
        self._extend(self.sequences)

    def statistics(self, tokens: list) -> list[int]:
        """Longest match that ends at each token."""
        nxt, link, length = self.next, self.link, self.length
        state, n, out = 0, 0, []
        for t in tokens:
            while state and t not in nxt[state]:
                state = link[state]
                n = length[state]
            if t in nxt[state]:
                state = nxt[state][t]
                n += 1
            out.append(n)
        return out


def judge(group: list[Block], window: int) -> list[np.ndarray]:
    """Which windows of each block occur in a block of an earlier document."""
    out = [np.zeros(b.count, bool) for b in group]
    order = sorted(range(len(group)), key=lambda i: (group[i].key, group[i].first_doc))
    for _, shard in groupby(order, key=lambda i: group[i].key):
        ids = list(shard)
        earlier = Automaton()
        last = group[ids[-1]].first_doc
        for doc, same in groupby(ids, key=lambda i: group[i].first_doc):
            mine = [(i, group[i].data.split(b" ")) for i in same]
            if earlier.sequences:
                for i, words in mine:
                    out[i] = np.array(earlier.statistics(words)[window - 1:]) >= window
            if doc != last:
                for _, words in mine:
                    earlier.add(words)
    return out


def _read(raw: np.ndarray, off: np.ndarray):
    starts, ends = word_bounds(raw, off)
    hashes = word_hashes(raw, starts, ends)
    return (lambda s, e: hashes[s:e]), np.searchsorted(starts, off)


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text, np.uint8)
    return word_bounds(raw, np.array([0, len(raw)]))


def _cut(text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
    starts, ends = _words(text)
    return [b" ".join(text[starts[k]:ends[k]] for k in range(s, s + n)) for s, n in spans]


def _windows(data: bytes, window: int) -> list[tuple[int, int]]:
    starts, ends = _words(data)
    return [(int(starts[i]), int(ends[i + window - 1])) for i in range(len(starts) - window + 1)]


def method(window: int = WINDOW, gram: int = GRAM, hot: int = 8192) -> Method:
    return Method(window, gram, _read, _cut, _windows, judge, everywhere=False, hot=hot)


SCHEMA = "doc_id long, n_words long, n_removed long, kept binary"


def drop_repeated_passages(docs: DataFrame, how: Method | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of each row of ``docs`` (doc_id,
    text): the words that stay, joined by one space, in UTF-8."""
    how = how or method()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(4)]
            for doc_id, no_id, text, ranges in zip(*(b.column(i) for i in range(4))):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                words = raw.split()  # on bytes: the six separators of the contract
                gone = covered(ranges.as_py(), len(words))
                kept = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
                for col, x in zip(out, (None if no_id.as_py() else doc_id.as_py(), len(words), len(words) - len(kept), b" ".join(kept))):
                    col.append(x)
            kinds = [pa.int64()] * 3 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "n_words", "n_removed", "kept"])

    return with_ranges(docs, how).select("doc_id", "no_id", "text", "ranges").mapInArrow(remove, SCHEMA)
