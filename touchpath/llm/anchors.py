"""Content-defined anchors: how repeated windows of a corpus meet.

A window is a run of ``window`` values (bytes or words) of one document.  Its
anchor is its least ``gram``-value hash, the leftmost of equals; it depends on
the window's content alone, so equal windows have equal anchors at equal places.
Consecutive windows mostly share an anchor: a block is such a run of windows.
A document is described by its blocks, one for every dozens of values, and each
of its windows lies in exactly one block.

Windows of different documents can be equal only in blocks of one key (the
anchor's hash).  Blocks with equal content need no further look, so only
distinct blocks of one key are compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from touchpath.llm.texthash import Runs, mix

_U = np.uint64
#: Bits of a place within a segment; hashes keep the others.
_PLACE_BITS = 24
#: Windows of one segment; longer documents are cut (a cut splits a block).
SEGMENT = 1 << 17


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries, by doubling."""
    out, have = x, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[:len(out) - (width - have)], out[width - have:])
    return out


def blocks(values: Callable[[int, int], np.ndarray], off: np.ndarray, window: int, gram: int):
    """Blocks of the documents whose values lie at ``off[i]:off[i+1]`` (``values``
    gives those of a range): arrays (document, first window, windows, key,
    content hash, place of the anchor relative to the first window)."""
    out: list[tuple] = []
    total = int(off[-1])
    for s in range(0, max(0, total - window + 1), SEGMENT):
        e = min(total, s + SEGMENT + window - 1)
        part = values(s, e)
        runs = Runs(part)
        n = len(part) - gram + 1
        grams = runs.hash(np.arange(n), np.arange(gram, gram + n))
        placed = (grams & ~_U((1 << _PLACE_BITS) - 1)) | np.arange(n, dtype=_U)
        least = _sliding_min(placed, window - gram + 1)
        anchor = (least & _U((1 << _PLACE_BITS) - 1)).astype(np.int64)
        # windows that lie in one document
        first = np.arange(s, s + len(anchor))
        doc = np.searchsorted(off, first, "right") - 1
        inside = first + window <= off[doc + 1]
        change = np.ones(len(anchor) + 1, bool)
        change[1:-1] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
        cut = np.flatnonzero(change)
        start, count = cut[:-1], np.diff(cut)
        keep = inside[start]
        start, count = start[keep], count[keep]
        a = anchor[start]
        out.append((doc[start], first[start] - off[doc[start]], count, grams[a].view(np.int64),
                    mix(runs.hash(start, start + count + window - 1) + (a - start).astype(_U)).view(np.int64), a - start))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(x) for x in zip(*out))
