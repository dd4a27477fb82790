"""Exact dedup: a minimal perfect hash over the historical distinct digests.

Texts are equal when identical after lower-casing A-Z only; a text's digest is
the SHA-256 of its normalised UTF-8.  History (the older rows) is grouped by
digest and dealt into buckets by the digest's first word; a task builds one
minimal perfect hash per bucket: its slots hold the full digest, the winner's
locator and the number of rows.  Newer rows, grouped by digest first, look their
slot up and compare all 32 bytes there: members join the slot's group,
nonmembers form groups of their own.

Defined results: null text counts as empty, and empty texts are equal to each
other; of equal texts the largest doc_id stays (null is the smallest), and of
rows that repeat that doc_id just one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.llm.common import boxed, join_groups, same, stash

#: Keys of one hash bucket; a bucket is built and probed in one task.
BUCKET_KEYS = 50_000
#: Bits a key of a level of the hash (fixed value of the construction).
GAMMA = 1.5

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@F.arrow_udf(T.BinaryType())
def text_digest(text: pa.Array) -> pa.Array:
    """SHA-256 of each text, A-Z lower-cased (null as empty)."""
    return pa.array([hashlib.sha256((t or "").encode("utf-8", "surrogatepass").translate(_LOWER)).digest()
                     for t in text.to_pylist()], pa.binary())


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Position of each key at a level: its words mixed with the level."""
    with np.errstate(over="ignore"):
        x = words[:, 1] + words[:, 2] * np.uint64(2 * level + 1)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
    return (x % np.uint64(size)).astype(np.int64)


def build_hash(digests: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of a minimal perfect hash over distinct digests, and the slot of
    each.  At each level, the keys alone on their position take it; the others
    go to the next.  A key's slot is the number of taken positions before its
    own, so n keys fill the slots 0..n-1."""
    words = _words(digests)
    left, levels, place, base = np.arange(len(digests)), [], np.zeros(len(digests), np.int64), 0
    while len(left):
        size = max(64, int(len(left) * GAMMA))
        pos = _place(words[left], len(levels), size)
        taken = np.bincount(pos, minlength=size) == 1
        alone = taken[pos]
        place[left[alone]] = base + (np.cumsum(taken) - 1)[pos[alone]]
        base += int(taken.sum())
        levels.append(taken)
        left = left[~alone]
    return levels, place


def find_slots(levels: list[np.ndarray], digests: list[bytes]) -> np.ndarray:
    """Slot of each digest; -1 if no level knows its position (a stranger may
    also get a member's slot, which the comparison of digests tells)."""
    words, slots, base = _words(digests), np.full(len(digests), -1, np.int64), 0
    left = np.arange(len(digests))
    for k, taken in enumerate(levels):
        pos = _place(words[left], k, len(taken))
        hit = taken[pos]
        slots[left[hit]] = base + (np.cumsum(taken) - 1)[pos[hit]]
        base += int(taken.sum())
        left = left[~hit]
    return slots


INDEX_SCHEMA = "bucket long, sizes array<long>, bits binary, digests binary, keep binary, rows binary"


def build_index(groups: DataFrame, buckets: int) -> DataFrame:
    """The index over ``groups`` (digest, keep, n): a row for each bucket with
    the levels' bits and, slot by slot, digest, winner's locator and rows."""

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        levels, slot = build_hash(list(pdf["digest"]))
        order = np.argsort(slot)
        assert (slot[order] == np.arange(len(slot))).all()
        bits = np.packbits(np.concatenate(levels))
        return pd.DataFrame({
            "bucket": [key[0]], "sizes": [[len(x) for x in levels]], "bits": [bits.tobytes()],
            "digests": [b"".join(pdf["digest"].iloc[order])],
            "keep": [pdf["keep"].to_numpy(np.int64)[order].tobytes()],
            "rows": [pdf["n"].to_numpy(np.int64)[order].tobytes()]})

    return groups.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInPandas(build, INDEX_SCHEMA)


def _bucket(buckets: int):
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(buckets))


def look_up(index: DataFrame, groups: DataFrame, buckets: int) -> DataFrame:
    """(digest, keep, n, member) of history and newer groups together: a newer
    group whose 32 bytes stand in its slot is added to it (the larger locator
    wins); every other one stays a group of its own."""

    def probe(key: tuple, ix: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        out = []
        digests, keep, n = list(new["digest"]), new["keep"].to_numpy(np.int64), new["n"].to_numpy(np.int64)
        member = np.zeros(len(new), bool)
        if len(ix):
            row = ix.iloc[0]
            sizes = [int(x) for x in row["sizes"]]
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:sum(sizes)].astype(bool)
            levels = np.split(bits, np.cumsum(sizes)[:-1])
            stored = [row["digests"][i:i + 32] for i in range(0, len(row["digests"]), 32)]
            win, rows = np.frombuffer(row["keep"], np.int64).copy(), np.frombuffer(row["rows"], np.int64).copy()
            if digests:
                slot = find_slots(levels, digests)
                member = np.array([s >= 0 and stored[s] == d for s, d in zip(slot, digests)])
                at = slot[member]
                win[at] = np.maximum(win[at], keep[member])
                rows[at] += n[member]
            out.append(pd.DataFrame({"digest": stored, "keep": win, "n": rows, "member": True}))
        if digests:
            own = ~member
            out.append(pd.DataFrame({"digest": [d for d, o in zip(digests, own) if o], "keep": keep[own], "n": n[own], "member": False}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"digest": [], "keep": [], "n": [], "member": []})

    new = groups.withColumn("bucket", _bucket(buckets))
    return index.groupBy("bucket").cogroup(new.groupBy("bucket")).applyInPandas(probe, "digest binary, keep long, n long, member boolean")


def exact_duplicates(docs: DataFrame, history=None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, digest, keep_id,
    group_size, kept.

    ``history``: which rows the index is built from, a predicate on doc_id
    (without it, the older half of the range of ids).  It changes where a group
    is found, not the result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest("text").alias("digest"))
    # a row's place: rises with doc_id, null first, one number per row
    rows = stash(rows.withColumn("part", F.monotonically_increasing_id()), "digests")
    total, low, high = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    if history is None:
        history = F.col("doc_id") <= ((low or 0) + (high or 0)) // 2
    old = F.coalesce(history, F.lit(True))

    # locators are compared as numbers: doc_id, with null below all others
    locator = F.coalesce("doc_id", F.lit(-(1 << 63)))

    def grouped(side: DataFrame) -> DataFrame:
        return side.groupBy("digest").agg(F.max(locator).alias("keep"), F.count(F.lit(1)).alias("n"))

    buckets = max(1, -(-total // BUCKET_KEYS))
    index = build_index(grouped(rows.where(old)), buckets)
    groups = stash(look_up(index, grouped(rows.where(~old)), buckets).select("digest", "keep", "n"), "groups", total)
    out = join_groups(rows, groups, "digest", "n", total)
    # of rows that repeat the winner's doc_id and text, the first one stays
    ties = rows.groupBy("digest", "doc_id").agg(F.min("part").alias("one"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    out = out.join(ties, same(out, ties, "digest", "doc_id"), "left").select(
        out["doc_id"], out["digest"], F.when(F.col("keep") > -(1 << 63), F.col("keep")).alias("keep_id"), F.col("n").alias("group_size"),
        ((locator_of(out) == F.col("keep")) & (F.coalesce(F.col("one"), F.col("part")) == F.col("part"))).alias("kept"))
    return out


def locator_of(df: DataFrame):
    return F.coalesce(df["doc_id"], F.lit(-(1 << 63)))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` (any columns) with one row of each group of equal texts."""
    key = F.concat("digest", F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8"))
    staying = exact_duplicates(docs.select("doc_id", "text")).where("kept").select(key.alias("_key"))
    rows = boxed(docs).withColumn("digest", text_digest("row.text")).withColumn("doc_id", F.col("row.doc_id").cast("long"))
    rows = rows.select("row", key.alias("_key"))
    # copies have keys of their own here (the id is part of it), so no task
    # gets a whole group; a repeated (doc_id, text) shares one and stays once
    return rows.join(staying, "_key", "left_semi").dropDuplicates(["_key"]).select("row.*")
