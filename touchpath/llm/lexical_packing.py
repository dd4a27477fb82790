"""Packing by lexical retrieval: windows of documents that share rare terms.

Documents are tokenised and closed with an end token.  Whole windows at the head of
a long document are sequences of their own, made where it is tokenised; its rest,
shorter than a window, goes on as the document to pack.  These are dealt into
shards of lexically close ones: in the order of their most telling terms (tf * idf
over the whole corpus), cut into ranges on Spark and within a range into shards of
bounded size.  A term is a token id, so the corpus statistics are bounded by the
vocabulary, whatever the corpus.

A shard's documents form an inverted index with BM25 weights (corpus-wide
document frequencies and mean length; terms in over half of all documents have
no weight).  A document opens a window; the index returns the unused documents of
the shard by their score for the one that opened it, and the best that fit are
taken until none does; the best of those left is then cut to fill the window, and
its rest opens the next.  A window open at the end of a shard goes on in the next
one of the range; one open at the end of a range is cut into sequences whose
lengths are powers of two, which need no padding.  So no sequence is padded at all.

Defined results: null or empty text is a document of the end token alone; rows
that repeat a doc_id are documents each; a null doc_id stays null; an empty table
gives an empty result; ties go by the order of shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import stash
from touchpath.llm.packing import default_ranks, encoder

CAPACITY = 1024
END_ID = 0
#: Ids are below this bound (of the vocabulary and the end token).
VOCABULARY = 1 << 16
#: BM25's saturation of term frequencies and weight of lengths.
K1, B = 1.2, 0.75
#: Documents of a shard (each is shorter than a window).
SHARD_DOCS = 1_000
#: Telling terms that order documents.
TELLING = 3
#: Documents of a range: a task's work.
RANGE_DOCS = 8_000


# --- ids and corpus statistics ----------------------------------------------

TOKENS = "doc_id long, doc_tokens long, start long, ids binary, sequence_id long, ids_crc32 long, df binary"


def tokens_of(docs: DataFrame, ranks: str, capacity: int, end_id: int) -> DataFrame:
    """Rows of three kinds from ``docs`` (doc_id, text): the rest of each document
    (``ids``: little-endian unsigned 16-bit numbers), its whole windows (without
    ids, but with a ``sequence_id`` below 0 and their CRC-32), and one row per task
    with the document frequencies of its rests (``df``: longs, by id)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = [c.split()[0] for c in TOKENS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_in = encoder(ranks)
        df = np.zeros(VOCABULARY, np.int64)
        sequence = -1 - (TaskContext.get().partitionId() << 40)
        for b in batches:
            out = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(ids_in(text.as_py() or ""), np.uint32(end_id)).astype("<u4", copy=False)
                whole = len(ids) // capacity * capacity
                for at in range(0, whole, capacity):
                    out.append((doc_id, len(ids), at, None, sequence, zlib.crc32(ids[at:at + capacity].tobytes()), None))
                    sequence -= 1
                if whole < len(ids):
                    rest = ids[whole:].astype("<u2")
                    df[terms(rest)[0]] += 1
                    out.append((doc_id, len(ids), whole, rest.tobytes(), None, None, None))
            if out:
                yield batch(out)
        if df.any():
            yield batch([(None, None, None, None, None, None, df.astype("<i8").tobytes())])

    return rows.mapInArrow(encode, TOKENS)


def terms(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids of a document (its end token aside) and how often each is there."""
    line = np.sort(ids[:-1])
    at = np.flatnonzero(np.append(line[1:] != line[:-1], True)[:len(line)])
    return line[at].astype(np.int64), np.diff(at, prepend=-1)


class Statistics:
    """Corpus-wide: idf of every id (0 in over half of the documents), and the
    mean number of ids of a document."""

    def __init__(self, df: np.ndarray, docs: int, mean: float) -> None:
        with np.errstate(divide="ignore", invalid="ignore"):
            idf = np.log((docs - df + 0.5) / (df + 0.5))
        self.idf = np.where(df > 0, np.maximum(idf, 0.0), 0.0)
        self.mean = mean

    def weights(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a document with a weight, and their BM25 weights in it."""
        own, tf = terms(ids)
        own, tf = own[self.idf[own] > 0], tf[self.idf[own] > 0]
        length = len(ids) - 1
        return own, self.idf[own] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.mean))

    def telling(self, ids: np.ndarray) -> list[int]:
        """The terms of the largest tf * idf that another document may share,
        largest first; -1 where there are fewer."""
        own, tf = terms(ids)
        score = tf * self.idf[own]
        best = [-1] * TELLING
        for k in range(min(TELLING, len(own))):
            i = int(np.argmax(score))
            if score[i] > 0:
                best[k], score[i] = int(own[i]), 0.0
        return best


def statistics(tokens: DataFrame) -> Statistics:
    """Of all documents; the sums are at most one row per id of the vocabulary."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for df in b.column(0):
                n = np.frombuffer(df.as_py(), "<i8")
                own = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(n[own], pa.int64())], names=["id", "n"])

    parts = tokens.where("df IS NOT NULL").select("df").mapInArrow(unpack, "id int, n long")
    df = np.zeros(VOCABULARY, np.int64)
    for r in parts.groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most the vocabulary
        df[r["id"]] = r["n"]
    docs, length = tokens.where("ids IS NOT NULL").agg(F.count(F.lit(1)), F.avg(F.length("ids") / 2 - 1)).first()
    # a term of one document leads to no other
    df[df == 1] = 0
    return Statistics(df, docs, max(length or 0.0, 1.0))


# --- shards -------------------------------------------------------------------

class Shard:
    """An inverted index: documents by term, with BM25 weights."""

    def __init__(self, docs: list[np.ndarray], stats: Statistics) -> None:
        per = [stats.weights(ids) for ids in docs]
        self.own = [own for own, _ in per]
        term = np.concatenate([own for own, _ in per]) if per else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in per]) if per else np.zeros(0)
        doc = np.repeat(np.arange(len(per)), [len(own) for own in self.own])
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.starts = np.searchsorted(term[order], np.arange(VOCABULARY + 1))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Every document's BM25 score for the distinct terms ``query``."""
        a, b = self.starts[query], self.starts[query + 1]
        many = b - a
        at = np.repeat(a - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        return np.bincount(self.doc[at], self.weight[at], minlength=len(self.own))


#: A piece: number of the document in its task, start, length.
Piece = tuple[int, int, int]


def powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """A part of a window as sequences whose lengths are powers of two."""
    left = sum(n for _, _, n in pieces)
    queue = list(reversed(pieces))
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            doc, start, n = queue.pop()
            take = min(n, room)
            out.append((doc, start, take))
            if take < n:
                queue.append((doc, start + take, n - take))
            room -= take
        yield out


class Windows:
    """Fills windows from shard after shard; full ones come out of :meth:`add`."""

    def __init__(self, capacity: int = CAPACITY) -> None:
        self.capacity = capacity
        self.open: list[Piece] = []
        self.room = capacity
        self.query = np.zeros(0, np.int64)

    def _put(self, piece: Piece, out: list[list[Piece]]) -> None:
        self.open.append(piece)
        self.room -= piece[2]
        if not self.room:
            out.append(self.open)
            self.open, self.room = [], self.capacity

    def add(self, first: int, docs: list[np.ndarray], stats: Statistics) -> list[list[Piece]]:
        """Pack a shard's documents, each shorter than a window, numbered from ``first``."""
        out: list[list[Piece]] = []
        index = Shard(docs, stats)
        length = np.array([len(d) for d in docs])
        unused = np.ones(len(docs), bool)
        seeds = iter(range(len(docs)))
        while unused.any():
            if not self.open:
                seed = next(i for i in seeds if unused[i])
                unused[seed] = False
                self.query = index.own[seed]
                self._put((first + seed, 0, int(length[seed])), out)
                continue
            scores = index.scores(self.query)
            # the best that fit, until none does
            while self.open:
                fits = unused & (length <= self.room)
                if not fits.any():
                    break
                i = int(np.argmax(np.where(fits, scores, -1.0)))
                unused[i] = False
                self._put((first + i, 0, int(length[i])), out)
            if self.open and unused.any():
                i = int(np.argmax(np.where(unused, scores, -1.0)))
                unused[i] = False
                cut = self.room
                self._put((first + i, 0, cut), out)
                # its rest opens the next window
                self.query = index.own[i]
                self._put((first + i, cut, int(length[i]) - cut), out)
        return out

    def close(self) -> list[list[Piece]]:
        out = list(powers(self.open))
        self.open, self.room = [], self.capacity
        return out


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: A document to pack: doc_id, its tokens in all, those before its rest, the rest's ids.
Rest = tuple[int | None, int, int, np.ndarray]


def pack_range(rows: Iterator[Rest], stats: Statistics, number: int, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> Iterator[tuple]:
    """Pieces of the documents of one range, shard by shard; ``number`` makes its
    sequences' numbers its own."""
    windows = Windows(capacity)
    held: dict[int, Rest] = {}
    done, sequence = 0, number << 40

    def emit(sequences: list[list[Piece]]) -> Iterator[tuple]:
        nonlocal sequence
        for pieces in sequences:
            offset = 0
            for doc, start, n in pieces:
                doc_id, total, before, ids = held[doc]
                yield doc_id, before + start, n, zlib.crc32(ids[start:start + n].astype("<u4").tobytes()), total, sequence, offset
                offset += n
            sequence += 1

    def flush(docs: list[Rest]) -> Iterator[tuple]:
        nonlocal done, held
        # documents of an open window are still needed
        held = {d: held[d] for d, _, _ in windows.open} | dict(enumerate(docs, done))
        first, done = done, done + len(docs)
        yield from emit(windows.add(first, [ids for *_, ids in docs], stats))

    shard: list[Rest] = []
    for row in rows:
        shard.append(row)
        if len(shard) == shard_docs:
            yield from flush(shard)
            shard = []
    if shard:
        yield from flush(shard)
    yield from emit(windows.close())


def pack_documents(docs: DataFrame, ranks: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise and pack ``docs`` (doc_id, text): (doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    tokens = stash(tokens_of(docs, ranks or default_ranks(), capacity, end_id), "ids")
    stats = statistics(tokens)  # travels with the functions below; bounded by the vocabulary
    rests = tokens.where("ids IS NOT NULL").select("doc_id", "doc_tokens", "start", "ids")
    telling = [f"t{i}" for i in range(TELLING)]

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.array([stats.telling(np.frombuffer(x.as_buffer(), "<u2")) for x in b.column(3)], np.int32).reshape(-1, TELLING)
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(keys[:, i]) for i in range(TELLING)]], names=[*b.schema.names, *telling])

    keyed = rests.mapInArrow(order, "doc_id long, doc_tokens long, start long, ids binary, " + ", ".join(f"{t} int" for t in telling))
    ranges = max(1, -(-rests.count() // RANGE_DOCS))
    keys = [*telling, F.xxhash64("ids"), "doc_id", "start"]
    dealt = keyed.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).select(*rests.columns)
    names = [c.split()[0] for c in PIECES.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def documents() -> Iterator[Rest]:
            for b in batches:
                for doc_id, total, before, ids in zip(*[b.column(i).to_pylist() for i in range(4)]):
                    yield doc_id, total, before, np.frombuffer(ids, "<u2")

        pieces = pack_range(documents(), stats, TaskContext.get().partitionId(), capacity)
        while some := list(islice(pieces, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*some)], names=names)

    whole = tokens.where("sequence_id IS NOT NULL").select(
        "doc_id", "start", F.lit(capacity).cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(dealt.mapInArrow(pack, PIECES))
