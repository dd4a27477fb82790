"""Best-fit packing by bin completion.

Documents are tokenised, closed with an end token and cut into pieces of at
most one sequence; the pieces are packed whole.  Only lengths matter to the
packing, and there are at most ``capacity`` of them, so the search runs on the
histogram of lengths (bounded by the capacity, whatever the corpus): it yields
patterns (lengths that share a sequence) with multiplicities.  Pieces are then
numbered within their length and dealt to the patterns' places on Spark.

Bin completion: the largest piece left opens a sequence; its undominated
fillings are tried, the fullest first; a branch ends when the waste so far
cannot beat the incumbent, whose start is best-fit decreasing.

Defined results: null or empty text is a document of the end token alone; an
empty table gives an empty result; repeated rows are packed each by itself.
"""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import boxed, numbered, stash

CAPACITY = 1024
END_ID = 2
#: Nodes that the search may visit after its first descent (4 per length are
#: added for that); the incumbent stands when they are used up.
NODES = 2_000
#: Steps of looking for a filling that count as a node.
LOOKS = 256
#: The vocabulary's added token, recognised in texts.
MARK = {"<|endoftext|>": 50256}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids (unsigned 32-bit) by the byte-level BPE of a rank file and its added token; a
    worker process keeps it in the tokenizer library's own table of encodings."""
    import public_tokenizers
    import tiktoken
    from tiktoken.registry import ENCODINGS

    if path not in ENCODINGS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        ENCODINGS[path] = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=MARK)
    enc = ENCODINGS[path]
    return lambda text: enc.encode_to_numpy(text, allowed_special="all", disallowed_special=())


def default_ranks() -> str:
    """The ranks of the vocabulary ``byte_bpe_50k.json``."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def token_pieces(docs: DataFrame, ranks: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every text of ``docs`` (doc_id,
    text): ids are little-endian unsigned 32-bit.  A document over the capacity
    is cut so that all pieces but the first are full."""
    path = ranks or default_ranks()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def cut(batches):
        ids_in = encoder(path)
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            texts = batch.column(1)
            cols: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(ids_of, texts):
                ids = np.append(ids_in(text.as_py() or ""), np.uint32(end_id)).astype("<u4", copy=False)
                head = len(ids) % capacity or capacity
                at = 0
                for piece, end in enumerate(range(head, len(ids) + 1, capacity)):
                    for col, x in zip(cols, (doc_id, piece, at, end - at, ids[at:end].tobytes())):
                        col.append(x)
                    at = end
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                names=["doc_id", "piece", "start", "length", "ids"])

    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


# --- the search, on a histogram ---------------------------------------------

def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: patterns with multiplicities.

    Each length in turn goes to the fullest sequences that hold it; sequences
    of one content are one group, so the work depends on the lengths alone."""
    groups: dict[tuple[int, ...], int] = {}
    room: dict[int, list[tuple[int, ...]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fit = next((r for r in range(length, capacity + 1) if room.get(r)), None)
            if fit is None:
                each = capacity // length
                for k, many in ((each, left // each), (left % each, 1)):
                    if k and many:
                        pattern = (length,) * k
                        groups[pattern] = groups.get(pattern, 0) + many
                        if pattern not in room.setdefault(capacity - length * k, []):
                            room[capacity - length * k].append(pattern)
                left = 0
                continue
            pattern = room[fit][-1]
            have = groups[pattern]
            each = fit // length
            many = min(have, left // each)
            take, k = (many, each) if many else (1, left)
            grown = pattern + (length,) * k
            groups[pattern] -= take
            if not groups[pattern]:
                del groups[pattern]
                room[fit].pop()
            groups[grown] = groups.get(grown, 0) + take
            rest = fit - length * k
            if grown not in room.setdefault(rest, []):
                room[rest].append(grown)
            left -= take * k
    return list(groups.items())


def _reach(lengths: list[int], counts: Sequence[int] | dict[int, int], space: int) -> list[int]:
    """For each place in ``lengths`` (descending): the sums up to ``space`` that
    the lengths from there on reach, as bits."""
    full = (1 << (space + 1)) - 1
    out = [1]
    for x in reversed(lengths):
        if out[-1] == full:  # one number for all places that reach everything
            out.append(out[-1])
            continue
        sums, left, k = out[-1], min(counts[x], space // x), 1
        while left:
            take = min(k, left)
            sums |= sums << (take * x) & full
            left -= take
            k *= 2
        out.append(sums)
    return out[::-1]


def _smear(bits: int, most: int) -> int:
    """``bits`` and what lies up to ``most`` places below each of them."""
    have = 0
    while have < most:
        step = min(have + 1, most - have)
        bits |= bits >> step
        have += step
    return bits


def fillings(lengths: list[int], counts: Sequence[int] | dict[int, int], space: int, waste: int) -> Iterator[tuple[int, ...] | None]:
    """All undominated fillings of ``space`` that leave ``waste`` of it at most,
    the fullest first and of equal sums the one with larger pieces first.

    A filling is dominated if a piece outside could take the place of some of
    its pieces (or of none): one larger piece that still fits, or one of the
    same size as several.  After every :data:`LOOKS` steps without a filling
    there is a None, so the caller can give up."""
    usable = [x for x in lengths if x <= space and counts[x] > 0]
    forced: list[int] = []  # pieces that would fit beside any filling without them
    held = 0
    reach, avail, looks = _reach(usable, counts, space), sum(1 << x for x in usable), 0
    for spare in range(min(space, waste) + 1):
        while usable and usable[-1] <= spare:
            x = usable.pop()
            held += x * counts[x]
            if held > space - spare:
                return
            forced[:0] = [x] * counts[x]
            avail ^= 1 << x
            reach = []
        goal = space - spare - held
        if goal < 0:
            return
        reach = reach or _reach(usable, counts, space)
        if not reach[0] >> goal & 1:
            continue
        index = array("l", [0]) * (usable[0] + 1 if usable else 1)
        for i, x in enumerate(usable):
            index[x] = i

        def whole(used: tuple[int, ...], free: int) -> bool:
            """No piece outside can replace pieces that are forced."""
            if not forced:
                return True
            sums, several = 1, 0
            for x in (*forced, *used):
                several |= several << x | (sums ^ 1) << x
                sums |= sums << x
            return not (free & several or spare and _smear(free >> 1, spare - 1) & sums)

        def extend(used: tuple[int, ...], rest: int, below: int, free: int, bad: int) -> Iterator[tuple[int, ...] | None]:
            """``free``: lengths with pieces left; ``bad``: lengths that a piece
            outside would replace together with pieces used."""
            nonlocal looks
            if not rest:
                if whole(used, free):
                    yield (*used, *forced)
                return
            open_ = avail & ((1 << min(below, rest + 1)) - 1) & ~bad
            if spare:
                open_ &= ~_smear(free >> 1, spare - 1)
            while open_:
                x = open_.bit_length() - 1
                open_ ^= 1 << x
                looks += 1
                if looks % LOOKS == 0:
                    yield None
                if not reach[index[x]] >> rest & 1:
                    return  # nor do the smaller ones alone
                near = _smear(free, spare)
                states, now, k = [], bad, 0
                while k < min(counts[x], rest // x) and not now >> x & 1:
                    now |= now >> x | near >> x
                    k += 1
                    states.append(now)
                for k in range(len(states), 0, -1):
                    left = rest - k * x
                    if reach[index[x] + 1] >> left & 1:
                        yield from extend((*used, *[x] * k), left, x, free ^ (1 << x) if k == counts[x] else free, states[k - 1])

        yield from extend((), goal, space + 1, avail, 0)


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with multiplicities that hold every piece of the histogram.

    Depth-first branch and bound.  A node takes the largest length left and one
    of its fillings as often as the counts and the waste allow, then, behind all
    fillings, fewer times; the waste allowed is that of one sequence fewer than
    the incumbent's, so a branch whose waste passes it is cut.  The first
    descent takes the fullest filling everywhere.  The search ends when no
    branch is left, which proves the incumbent, or with the budget of nodes."""
    counts = {x: n for x, n in counts.items() if n}
    total = sum(x * n for x, n in counts.items())
    if not counts:
        return []
    best = best_fit(counts, capacity)
    best_n = sum(n for _, n in best)
    least = -(-total // capacity)
    order = sorted(counts, reverse=True)

    def expand(left: list[int], waste: int) -> Iterator[tuple[tuple[int, ...], int] | None]:
        top = next(x for x in order if left[x])
        beside = left[:]
        beside[top] -= 1
        again = False
        for fewer in (False, True):
            if fewer and not again:
                return
            for f in fillings(order, beside, capacity - top, waste):
                if f is None:
                    yield None
                    continue
                pattern = (top, *f)
                n = min((beside[x] + (x == top)) // pattern.count(x) for x in set(pattern))
                spare = capacity - sum(pattern)
                n = min(n, waste // spare) if spare else n
                again = again or n > 1
                for k in range(n - 1, 0, -1) if fewer else (n,):
                    yield pattern, k

    # pieces left of each length: as many nodes are open at once as there are
    # patterns, and each keeps a copy, which as a list is small
    left, made, waste, seen = [counts.get(x, 0) for x in range(order[0] + 1)], [], 0, 0
    remaining = sum(left)
    stack: list[list] = []  # open choices: [untried patterns, patterns made, waste]
    dead = False
    while best_n > least:
        allowed = (best_n - 1) * capacity - total
        if not dead and remaining == 0:
            best, best_n, dead = list(made), sum(n for _, n in made), True
            continue
        if not dead:
            stack.append([expand(left, allowed - waste), len(made), waste])
        dead = False
        if not stack:
            break
        seen += 1
        if seen > nodes + 4 * len(order):
            break
        # go back to the deepest node with an untried filling
        untried, depth, before = stack[-1]
        choice = next(untried, ())
        if not choice:
            if choice is not None:  # none is left, rather than none found yet
                stack.pop()
            dead = True
            continue
        while len(made) > depth:
            pattern, n = made.pop()
            for x in pattern:
                left[x] += n
            remaining += n * len(pattern)
        pattern, n = choice
        for x in pattern:
            left[x] -= n
        remaining -= n * len(pattern)
        made.append((pattern, n))
        waste = before + n * (capacity - sum(pattern))
        # a better incumbent since the node was opened allows less
        if waste > allowed:
            dead = True
    return best


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[list[int], list[tuple[int, int, int]]]]:
    """For each length: the first number of each run of pieces, and the run's
    (first sequence, copies of the length in the pattern, offset of the first)."""
    runs: dict[int, tuple[list[int], list[tuple[int, int, int]]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for x in dict.fromkeys(pattern):
            k = pattern.count(x)
            starts, at = runs.setdefault(x, ([], []))
            starts.append(used.get(x, 0))
            at.append((sequence, k, offset))
            used[x] = used.get(x, 0) + n * k
            offset += x * k
        sequence += n
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (doc_id, piece, length and any
    payload): the pieces of one sequence_id fill it from 0 without gaps."""
    rows = boxed(pieces.drop("sequence_id", "offset")).select(
        "row", F.col("row.length").cast("long").alias("length"), F.col("row.doc_id").alias("doc_id"), F.col("row.piece").alias("piece"))
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    runs = places(bin_completion(counts, capacity, nodes))

    @F.pandas_udf("sequence_id long, offset long")
    def deal(length: pd.Series, no: pd.Series) -> pd.DataFrame:
        seq, off = [], []
        for x, i in zip(length, no):
            starts, at = runs[x]
            r = bisect_right(starts, i) - 1
            first, k, offset = at[r]
            which = i - starts[r]
            seq.append(first + which // k)
            off.append(offset + which % k * x)
        return pd.DataFrame({"sequence_id": seq, "offset": off}, dtype="int64")

    ranked = numbered(rows, ["length"], [F.col("doc_id"), F.col("piece")], "no")
    return ranked.withColumn("place", deal("length", "no")).select("row.*", "place.sequence_id", "place.offset")


def pack_documents(docs: DataFrame, ranks: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise and pack ``docs``; pieces carry the CRC-32 of their ids."""
    pieces = token_pieces(docs, ranks, capacity, end_id).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(stash(pieces, "pieces"), capacity)
