"""Substring dedup by a hash-compared suffix sort: bytes of every string of
``window`` bytes that starts anywhere else as well are removed.

The suffix array is built in buckets: suffixes that share their anchor and its
distance (see ``anchors``, ``repeats``) are sorted with each other, since only
those can agree on a whole window.  Where their first eight bytes agree too, the
sort is a mergesort; a comparison finds the common extension of two suffixes by a
binary search over prefix polynomial hashes, so it takes a logarithm of the
window's length.  Neighbours that agree
on a window by hash are compared byte by byte; if a collision ever shows, the
batch is sorted again under other hashes.

Defined results: null and empty texts have no bytes and lose none; matches never
cross documents; repeated rows are occurrences like others, so rows of a
window or more that occur twice lose all their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from touchpath.llm.repeats import Block, Method, _runs, covered, with_ranges
from touchpath.llm.texthash import Runs, byte_values

WINDOW = 200
GRAM = 32


class Suffixes:
    """Comparison of suffixes of ``text`` on their first ``window`` bytes."""

    def __init__(self, text: np.ndarray, window: int, seed: int = 0):
        self.text, self.window = text, window
        runs = Runs(byte_values(seed)[text])
        self.prefix, self.back = runs.prefix, runs.back

    def _hash(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.prefix[at + n] - self.prefix[at]) * self.back[at]

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self._hash(a, self.window) == self._hash(b, self.window)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension, at most the window."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.window, np.int64)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) // 2
            same = self._hash(a, mid) == self._hash(b, mid)
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """a < b, or a <= b where ``or_equal``."""
        out = or_equal & self.equal(a, b)
        at = np.flatnonzero(~self.equal(a, b))
        n = self.common(a[at], b[at])
        out[at] = self.text[a[at] + n] < self.text[b[at] + n]
        return out


def merge_sort(starts: np.ndarray, first: np.ndarray, length: np.ndarray, order: Suffixes) -> np.ndarray:
    """Sort ``starts`` within segments (``first``, ``length`` of each entry's
    segment): runs of 1, 2, 4.. are merged, all at once; an entry's place is its
    own rank plus its rank in the sister run, found by binary search."""
    place = np.arange(len(starts)) - first
    run = 1
    while True:
        active = np.flatnonzero(length > run)
        if not len(active):
            return starts
        pos, base, size = place[active], first[active], length[active]
        mine = pos // run
        left = mine % 2 == 0
        sister = np.where(left, mine + 1, mine - 1) * run
        low = np.minimum(sister, size)
        high = np.minimum(sister + run, size)
        begin = low.copy()
        own = starts[active]
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                break
            mid = (low[todo] + high[todo]) // 2
            other = starts[base[todo] + mid]
            # from the right run, equal entries of the left one come before
            before = order.less(other, own[todo], ~left[todo])
            low[todo[before]] = mid[before] + 1
            high[todo[~before]] = mid[~before]
        new = mine // 2 * 2 * run + pos % run + (low - begin)
        out = starts.copy()
        out[base + new] = own
        starts = out
        run *= 2


def judge(group: list[Block], window: int, seed: int = 0) -> list[np.ndarray]:
    """Which windows of each block occur in another one too."""
    if not group:
        return []
    text = np.frombuffer(b"".join(b.data for b in group), np.uint8)
    begin = np.cumsum([0, *(len(b.data) for b in group)])[:-1]
    count = np.array([b.count for b in group])
    owner = np.repeat(np.arange(len(group)), count)
    index = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    starts = begin[owner] + index
    # buckets: one anchor at one distance
    _, key = np.unique([b.key for b in group], return_inverse=True)
    bucket = key[owner] * (2 * window) + (np.array([b.lead for b in group])[owner] - index) + window
    # by bucket and first eight bytes; what agrees so far is a segment
    head = np.zeros(len(text), np.uint64)
    for k in range(8):
        head[:len(text) - 7] |= text[k:len(text) - 7 + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    sort = np.lexsort((head[starts], bucket))
    new = np.ones(len(sort), bool)
    new[1:] = (bucket[sort[1:]] != bucket[sort[:-1]]) | (head[starts[sort[1:]]] != head[starts[sort[:-1]]])
    cut = np.flatnonzero(new)
    size = np.diff(np.append(cut, len(sort)))
    first, length = np.repeat(cut, size), np.repeat(size, size)
    suffixes = Suffixes(text, window, seed)
    done = merge_sort(starts[sort], first, length, suffixes)
    same = np.zeros(len(done), bool)
    pair = np.flatnonzero(first[1:] == first[:-1])
    pair = pair[suffixes.equal(done[pair], done[pair + 1])]
    for at in range(0, len(pair), 4096):
        rows = pair[at:at + 4096, None]
        reach = np.arange(window)
        if (text[done[rows] + reach] != text[done[rows + 1] + reach]).any():
            return judge(group, window, seed + 1)
    same[pair] = same[pair + 1] = True
    hit = np.zeros(len(text), bool)
    hit[done[same]] = True
    return [hit[s:s + n] for s, n in zip(begin, count)]


def _read(raw: np.ndarray, off: np.ndarray):
    values = byte_values()
    return (lambda s, e: values[raw[s:e]]), off


def _cut(text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
    return [text[s:s + n] for s, n in spans]


def _windows(data: bytes, window: int) -> list[tuple[int, int]]:
    return [(i, i + window) for i in range(len(data) - window + 1)]


def method(window: int = WINDOW, gram: int = GRAM, hot: int = 8192) -> Method:
    return Method(window, gram, _read, _cut, _windows, judge, everywhere=True, hot=hot)


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def drop_repeated_bytes(docs: DataFrame, how: Method | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each row of ``docs``
    (doc_id, text): the bytes that stay, concatenated."""
    how = how or method()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for doc_id, no_id, text, ranges in zip(*(b.column(i) for i in range(4))):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                found = ranges.as_py()
                gone = covered(found, len(raw)) if found else np.zeros(0, bool)
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if found else raw
                for col, x in zip(out, (None if no_id.as_py() else doc_id.as_py(), len(raw), len(raw) - len(kept), len(_runs(gone)), kept)):
                    col.append(x)
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return with_ranges(docs, how).select("doc_id", "no_id", "text", "ranges").mapInArrow(remove, SCHEMA)
