"""Helpers shared by the operators: tables in the shared folder, skew-proof
numbering and joins, connected components, batches of UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.llm.texthash import Runs, byte_values
from touchpath.session import scratch_path
from touchpath.sources.sinks import remove


#: Rows of an Arrow batch: texts are long, and a worker holds a batch at a time.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Let the session send Arrow batches of few rows (Spark's 10,000 texts would
    take tens of MB on either side, and more where texts are long)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The columns of ``documents`` that an operator needs (all its rows)."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*cols)


#: Tables written in each scope that is open (see :func:`scratch`), the innermost last.
_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A scope whose intermediate tables are deleted at its end, also on failure:
    those that :func:`stash` writes in it, and no others.  What is derived from
    them has to be written before."""
    own: list[str] = []
    _SCOPES.append(own)
    try:
        yield
    finally:
        # by identity: scopes that hold the same are equal as lists
        _SCOPES[:] = [scope for scope in _SCOPES if scope is not own]
        for path in own:
            remove(spark, path)


#: Rows of a file of a table whose number of rows is bounded beforehand.
FILE_ROWS = 50_000


def written(df: DataFrame, name: str, rows: int | None = None, light: bool = False) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back, with its place: the
    lineage is cut by files that every executor sees, so a lost executor repeats
    nothing before them.  With a bound on its ``rows``, a small table is written as
    few files (opening one costs more than the rows of hundreds of partitions): they
    are dealt anew, or, if the last step is ``light``, made by as few tasks."""
    small_batches(df.sparkSession)
    files = None if rows is None else max(1, -(-rows // FILE_ROWS))
    if files is not None and files < parts(df.sparkSession):
        df = df.coalesce(files) if light else df.repartition(files)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stash(df: DataFrame, name: str, rows: int | None = None, light: bool = False) -> DataFrame:
    """An intermediate table (see :func:`written`), which goes with the innermost
    scope."""
    out, path = written(df, name, rows, light)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return out


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def boxed(df: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, so that working columns clash with
    none of them; ``select("row.*")`` undoes it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def same(left: DataFrame, right: DataFrame, *keys: str) -> Column:
    """Null-safe equality on ``keys`` (a null key is a key like any other)."""
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[k])
    return on


def numbered(df: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    """Add ``out``: 0, 1, 2.. within each group of ``keys``.

    A group of any size is cut into hash buckets; rows are numbered inside a
    bucket and shifted by the counts of the buckets before it, so no task
    holds a whole group.  The order is the same on every run (rows that agree
    in all of ``order`` are interchangeable).
    """
    cut = df.withColumn("_cut", F.pmod(F.xxhash64(*order), F.lit(max(8, parts(df.sparkSession)))))
    counts = cut.groupBy(*keys, "_cut").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*keys).orderBy("_cut").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inner = W.partitionBy(*keys, "_cut").orderBy(*order)
    rows = cut.withColumn("_no", F.row_number().over(inner) - 1)
    joined = rows.join(counts, same(rows, counts, *keys, "_cut"))
    return joined.select(*[rows[c] for c in df.columns], (F.col("_no") + F.col("_base")).cast("long").alias(out))


def join_groups(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, total: int) -> DataFrame:
    """Join rows to their group (one row per ``key``), whatever a group's size.

    Groups with over a thousandth of all ``total`` rows number under 1,000;
    those alone are broadcast.  All others are small and go by a shuffle.
    """
    hot = groups.where(F.col(size) * 1000 > total)
    cold = groups.where(F.col(size) * 1000 <= total)
    key = [key] if isinstance(key, str) else key
    flag = hot.select(*key, F.lit(True).alias("_hot"))
    marked = rows.join(F.broadcast(flag), key, "left")
    light = marked.where(F.col("_hot").isNull()).drop("_hot").join(cold, key)
    heavy = marked.where(F.col("_hot")).drop("_hot").join(F.broadcast(hot), key)
    return light.unionByName(heavy)


def components(edges: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of
    ``edges`` (columns a, b: longs).

    Alternating large-star and small-star steps; each is one grouped minimum
    (combined map-side) and one join, and each round is written to the shared
    folder.  Stops when a round leaves the edges as they are (told by their
    number and the exact sum of their hashes).  ``rows`` bounds the edges.

    An edge (a, b) with a > b stands for both directions: the large star only
    reaches a node's larger neighbours, that is a from b, and of b's neighbours
    only smaller ones can lie below b.  So a round reads each edge once, and its
    plan, which the driver holds for every round, stays small.
    """
    mark = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    cur = stash(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), name, rows, light=True)
    was = cur.agg(*mark).first()
    while was[0]:
        low = cur.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m"))
        large = cur.join(low, "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        pairs = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        small = pairs.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        cur = stash(small.where("a <> b").distinct(), name, was[0] * 2, light=True)
        now = cur.agg(*mark).first()
        if now == was:
            break
        was = now
    return cur.selectExpr("a AS node", "b AS component").unionByName(cur.selectExpr("b AS node", "b AS component").distinct())


# --- UTF-8 bytes of Arrow text columns ------------------------------------

def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column without copying; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_large_binary(column.type) and not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    n = len(column)
    if n == 0 or ends is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


#: Word separators of the corpus contracts: space and \t \n \v \f \r.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def word_bounds(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; words never cross a text's end."""
    solid = ~SEPARATOR[raw]
    if not len(solid):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(len(raw) + 1, bool)
    first[off] = True
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | first[:-1]))
    after = np.empty(len(raw), bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | first[1:])) + 1
    return starts, ends


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words given by their bounds; bytes are taken in parts, so
    memory does not grow with the text."""
    values, out = byte_values(), np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + (1 << 18))))
        at, end = starts[i], ends[j - 1]
        out[i:j] = Runs(values[raw[at:end]]).hash(starts[i:j] - at, ends[i:j] - at)
        i = j
    return out


@F.arrow_udf(T.LongType())
def count_words(text: pa.Array) -> pa.Array:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of each whole text (null: 0)."""
    raw, off = utf8(text)
    starts, _ = word_bounds(raw, off)
    return pa.array(np.diff(np.searchsorted(starts, off)))


def slices(off: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of up to ``most`` bytes together (one text at least)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
