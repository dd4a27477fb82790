"""Repeated windows across a corpus: the distributed part that passage and byte
dedup share.

1. Documents are described by blocks (see ``anchors``): key, content hash and
   place; one row for every dozens of values, written once.
2. Keys are counted with map-side combining; a key that occurs once is done
   with.  The others' blocks are grouped by (key, content): a block whose
   content occurs again is decided by that count alone; only keys with several
   distinct contents need the values themselves.
3. For those, one representative per content is cut out of its document and
   meets the others of its key in one task, which tells which of its windows
   are repeated.  Keys with over ``hot`` distinct contents go window by window
   through a grouping on the windows' digests instead, so that no task gets an
   unbounded group.
4. Ranges of repeated windows go back to their documents.

Documents meet their blocks and ranges on two 64-bit hashes of (doc_id, text);
the text is shuffled once, and both joins use that one exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchpath.llm.anchors import blocks
from touchpath.llm.common import join_groups, parts, stash, utf8
from touchpath.operators.membership import key_filter, possible_members, with_membership

BLOCKS = "row long, doc_id long, place long, key long, content long"
#: Least doc_id: stands for null, which ranks below all others.
LOWEST = -(1 << 63)


@dataclass(frozen=True)
class Method:
    """How documents are read as values, and how blocks of a key are judged."""

    window: int
    gram: int
    #: (bytes, offsets) of texts -> (values of a range, offsets in values)
    read: Callable[[np.ndarray, np.ndarray], tuple[Callable[[int, int], np.ndarray], np.ndarray]]
    #: (text, [(first, count)]) -> the values first .. first + count as bytes
    cut: Callable[[bytes, list[tuple[int, int]]], list[bytes]]
    #: values as bytes, window -> start and end byte of each window
    windows: Callable[[bytes, int], list[tuple[int, int]]]
    #: blocks of whole keys -> a mask of repeated windows for each block
    judge: Callable[[list["Block"], int], list[np.ndarray]]
    #: a window counts as repeated in its first document as well
    everywhere: bool
    hot: int = 8192
    #: rows of one key that may be counted beside each other in one task
    beside: int = 1 << 17


@dataclass
class Block:
    key: int
    content: int
    first_doc: int
    lead: int
    count: int
    data: bytes


def packed_place(first, count, lead):
    """First window, windows and anchor's place in one long."""
    return (first << 20) | (lead << 10) | count


def first_of(place: Column) -> Column:
    return F.shiftright(place, 20)


def count_of(place: Column) -> Column:
    return place.bitwiseAND(F.lit(1023).cast("long"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with the two hashes that name a row.  None of the join
    columns can be null, so both joins plan the same exchange of the text."""
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(doc_id.alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), text.alias("text"),
                       F.xxhash64(doc_id, text).alias("h1"), F.xxhash64(text, doc_id, F.lit(1)).alias("h2"))


def describe(docs: DataFrame, method: Method) -> DataFrame:
    """Block rows of ``docs`` (keyed), and for each document a header row of
    place -1 with its two hashes as key and content."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, doc_id, h1, h2 = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3, 4))
            raw, off = utf8(b.column(2))
            for i in range(0, len(row), 128):
                j = min(i + 128, len(row))
                values, at = method.read(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                doc, first, count, key, content, lead = blocks(values, at, method.window, method.gram)
                cols = [np.concatenate([row[i:j], row[i:j][doc]]), np.concatenate([doc_id[i:j], doc_id[i:j][doc]]),
                        np.concatenate([np.full(j - i, -1), packed_place(first, count, lead)]), np.concatenate([h1[i:j], key]), np.concatenate([h2[i:j], content])]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["row", "doc_id", "place", "key", "content"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "h1", "h2")
    return rows.mapInArrow(make, BLOCKS)


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """(first, length) of the runs of true entries."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return list(zip(edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist()))


def _warm(rows: DataFrame, groups: DataFrame, key: list[str], total: int, beside: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Groups that are not hot, but too large to be counted in one task: those of
    over ``beside`` rows.  There are none below ``beside`` * 1,000 rows in all.

    Returns the rows of such groups, all others, and the groups themselves; a few
    other groups may come with them, as whole groups (a bitmap of bounded size tells
    them apart, see ``operators/membership``)."""
    if total <= beside * 1000:
        return None
    words = key_filter(groups.where(F.col("n") > beside), key)
    return (possible_members(rows, key, words), with_membership(rows, key, words, "_may").where("NOT _may").drop("_may"),
            possible_members(groups, key, words))


def _hot(groups: DataFrame, key: list[str], total: int, value: str | None = None) -> tuple[Column, Column]:
    """Whether a row belongs to one of the groups with over a thousandth of all
    ``total`` rows, and that group's ``value``.  Such groups number under 1,000,
    so what passes the driver is bounded; rows of all others are few a group."""
    name = F.xxhash64(*key)
    found = groups.where((F.col("n") > 1) & (F.col("n") * 1000 > total)).select(name.alias("name"), F.col(value) if value else F.lit(0)).collect()
    if not found:
        return F.lit(False), F.lit(0).cast("long")
    values = F.create_map(*[F.lit(x).cast("long") for pair in found for x in pair])
    return name.isin([pair[0] for pair in found]), values[name]


def repeated_ranges(docs: DataFrame, method: Method) -> DataFrame:
    """(h1, h2, ranges): for each document of ``docs`` (keyed) that has any, the
    ranges (first value, values) that repeated windows cover."""
    described = stash(describe(docs, method), "blocks")
    names = described.where("place = -1").select("row", F.col("key").alias("h1"), F.col("content").alias("h2"))
    every = described.where("place >= 0")
    # most keys occur once, and those blocks are done with; rows are counted
    # beside each other, but those of hot keys, which are known beforehand
    total = every.count()
    keys = every.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot_key, _ = _hot(keys, ["key"], total)
    many, few = every.where(hot_key), every.where(~hot_key)
    warm = _warm(few, keys, ["key"], total, method.beside)
    if warm:
        # large groups occur more than once; a few single ones do no harm here
        many, few = many.unionByName(warm[0]), warm[1]
    beside = few.withColumn("n", F.count(F.lit(1)).over(W.partitionBy("key"))).where("n > 1").drop("n")
    again = stash(beside.unionByName(many), "again", total)
    n_again = again.count()

    # contents: how often, from which document on, and one block that has it
    contents = again.groupBy("key", "content").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"),
                                                   F.first("row").alias("row"), F.first("place").alias("place"))
    per_key = contents.groupBy("key").agg(F.count(F.lit(1)).alias("contents"))
    contents = stash(join_groups(contents, per_key, "key", "contents", n_again), "contents", n_again)

    # blocks decided by the count of their content, or by its first document
    hot_content, first_docs = _hot(contents, ["key", "content"], total, "first_doc")
    per = W.partitionBy("key", "content")
    few = again.where(~hot_content)
    warm = _warm(few, contents, ["key", "content"], total, method.beside)
    if warm:
        # joined by a shuffle whose large partitions AQE splits
        joined = warm[0].join(warm[2].select("key", "content", "n", "first_doc"), ["key", "content"]).select(*few.columns, "n", "first_doc")
        few = warm[1]
    rows = few.withColumn("n", F.count(F.lit(1)).over(per)).withColumn("first_doc", F.min("doc_id").over(per))
    rows = rows.unionByName(again.where(hot_content).withColumn("n", F.lit(total)).withColumn("first_doc", first_docs))
    if warm:
        rows = rows.unionByName(joined)
    rows = rows.where("n > 1") if method.everywhere else rows.where("doc_id > first_doc")
    decided = rows.select("row", first_of(F.col("place")).alias("first"), (count_of(F.col("place")) + method.window - 1).alias("length"))

    # one block per content, beside the other contents of its key
    rep = contents.where("contents > 1").select("key", "content", "first_doc", "row", "place", (F.col("contents") > method.hot).alias("hot"))
    cut = _cut(docs, rep, names, method)
    judged = _judged(cut.where("NOT hot"), method)
    hot = rep.where("hot").count()
    if hot:
        judged = judged.unionByName(_by_digest(cut.where("hot"), method, hot))
    if not method.everywhere:
        # a content's ranges hold for all its blocks in its first document
        mine = again.select("key", "content", "doc_id", "row", "place")
        judged = judged.select("key", "content", F.col("first_doc").alias("doc_id"), "at", "windows").join(mine, ["key", "content", "doc_id"])
    part = judged.select("row", (first_of(F.col("place")) + F.col("at")).alias("first"), (F.col("windows") + method.window - 1).alias("length"))

    ranges = decided.unionByName(part).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", "length"))).alias("r"))
    # rows alike in doc_id and text have the same ranges, but for those that represent a content
    return ranges.join(names, "row").groupBy("h1", "h2").agg(F.flatten(F.collect_set("r")).alias("ranges"))


def _cut(docs: DataFrame, rep: DataFrame, names: DataFrame, method: Method) -> DataFrame:
    """Representatives with their values (column data).  All columns of ``docs``
    go along, so that this join and the final one plan one and the same
    exchange of the texts."""
    per = rep.join(names, "row").groupBy("h1", "h2").agg(F.collect_list(F.struct("key", "content", "first_doc", "row", "place", "hot")).alias("blocks"))
    schema = "key long, content long, first_doc long, row long, place long, hot boolean, data binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for text, wanted in zip(b.column(2), b.column(3)):
                want = wanted.as_py()
                spans = [(w["place"] >> 20, (w["place"] & 1023) + method.window - 1) for w in want]
                for w, data in zip(want, method.cut(text.as_py().encode("utf-8", "surrogatepass"), spans)):
                    for col, x in zip(out, (w["key"], w["content"], w["first_doc"], w["row"], w["place"], w["hot"], data)):
                        col.append(x)
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["key", "content", "first_doc", "row", "place", "hot", "data"])

    return docs.join(per, ["h1", "h2"]).select("doc_id", "no_id", "text", "blocks").mapInArrow(cut, schema)


RANGES = "key long, content long, first_doc long, row long, place long, at long, windows long"


def _judged(cut: DataFrame, method: Method) -> DataFrame:
    """Ranges (first window, windows) of each representative, key by key."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if size > 1 << 19 and r[0] != held[-1][0]:
                    yield _ranges(held, method)
                    held, size = [], 0
                # a repeated row of the table brings its blocks again
                if not held or r[:2] != held[-1][:2]:
                    held.append(r)
                    size += len(r[5])
        yield _ranges(held, method)

    dealt = cut.select("key", "content", "first_doc", "row", "place", "data").repartition(parts(cut.sparkSession), "key")
    return dealt.sortWithinPartitions("key", "content").mapInArrow(judge, RANGES)


def _ranges(rows: list[tuple], method: Method) -> pa.RecordBatch:
    group = [Block(key, content, doc_id, place >> 10 & 1023, place & 1023, data) for key, content, doc_id, _, place, data in rows]
    out = []
    for (key, content, first_doc, row, place, _), mask in zip(rows, method.judge(group, method.window)):
        out += [(key, content, first_doc, row, place, at, n) for at, n in _runs(mask)]
    names = [c.split()[0] for c in RANGES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(7)], names=names)


def _by_digest(cut: DataFrame, method: Method, hot: int) -> DataFrame:
    """The same for keys of too many contents (``hot`` of them): every window by
    its digest."""
    schema = "key long, content long, first_doc long, row long, place long, at long, digest binary"

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                key, content, first_doc, row, place, data = r
                ds = [hashlib.blake2b(data[s:e], digest_size=16).digest() for s, e in method.windows(data, method.window)]
                n = len(ds)
                cols = [pa.array([x] * n, pa.int64()) for x in (key, content, first_doc, row, place)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(range(n), pa.int64()), pa.array(ds, pa.binary())],
                                                 names=["key", "content", "first_doc", "row", "place", "at", "digest"])

    # a repeated row of the table brings its blocks again
    dealt = cut.select("key", "content", "first_doc", "row", "place", "data").dropDuplicates(["key", "content"])
    spans = dealt.mapInArrow(spread, schema)
    seen = spans.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("first_doc").alias("least")).where("n > 1")
    # a block has fewer windows than a window has values, so this many at most
    hit = join_groups(spans, seen, "digest", "n", hot * method.window)
    if not method.everywhere:
        hit = hit.where("first_doc > least")
    return hit.select("key", "content", "first_doc", "row", "place", "at", F.lit(1).cast("long").alias("windows"))


def with_ranges(docs: DataFrame, method: Method) -> DataFrame:
    """``docs`` (doc_id, text) keyed, each row with its ranges (or null)."""
    rows = keyed(docs)
    return rows.join(repeated_ranges(rows, method), ["h1", "h2"], "left")


def covered(ranges: list[dict] | None, n: int) -> np.ndarray:
    """Mask of the ``n`` values of a document that its ranges cover."""
    step = np.zeros(n + 1, np.int32)
    for r in ranges or ():
        step[r["first"]] += 1
        step[r["first"] + r["length"]] -= 1
    return np.cumsum(step[:-1]) > 0
