"""Whitening of embeddings by the weighted multiplicity covariance.

Vectors are held as whole numbers on a grid, x = floor(SCALE * c) + SHIFT, and
rows with one x are grouped first: the fit works on distinct vectors, each with a
weight (its number of rows, or one), and each distinct vector is whitened once;
the result is joined back to all rows.

The covariance is a weighted centred product: tasks centre a block of vectors by
exact whole numbers (n * x - S), divide by n, and multiply it with itself; the
partial matrices are added row by row, in the order of their partitions.  Only
matrices of the dimension's size reach the driver, which takes their eigenvectors.

Defined results: a row whose vector is null, or holds null or non-finite entries,
is dropped; so is one whose length differs from that of most vectors (of several
such lengths, the largest), empty vectors among them; repeated rows stay, each by
itself; components whose eigenvalue is 0 to double precision do not exist (equal
vectors alone give no row); an empty table gives an empty result.  A deviation
that passes a long raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import boxed, join_groups, stash

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Eigenvalues below this share of the largest one, times the dimension, are 0.
FLAT = 1e-13
#: Vectors that are multiplied at once.
BLOCK = 4096


def on_grid(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """The whole numbers of a vector; null if it has null or non-finite entries."""
    wide = vector.cast("array<double>")
    bad = F.exists(wide, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~bad, F.transform(wide, lambda c: F.floor(c * float(scale)) + F.lit(shift).cast("long")))


def blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(vectors, weights) of Arrow batches (x, weight), some at a time."""
    for batch in batches:
        x = batch.column("x")
        flat = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        weight = batch.column("weight").to_numpy(zero_copy_only=False)
        for at in range(0, len(flat), BLOCK):
            yield flat[at:at + BLOCK], weight[at:at + BLOCK]


class Fit:
    """What a fit found: whole totals, and the components (one a column)."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float) -> None:
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, from exact whole numbers where they fit a long."""
        return times_n_less_s(x, self.n, self.sums).astype(np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def times_n_less_s(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: longs, or Python's numbers where longs may not do."""
    top = max(int(np.abs(x).max(initial=0)), 1)
    if n * top + max(map(abs, sums), default=0) < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of (n * x - S) ** 2, exactly."""
    y = times_n_less_s(x, n, sums)
    top = int(np.abs(y).max(initial=0))
    if top * top * max(1, y.shape[1]) >= 1 << 63:
        y = y.astype(object)
    return [int(v) for v in (y * y).sum(axis=1)]


def product(distinct: DataFrame, dim: int, rows_of) -> np.ndarray:
    """Weighted sum of r^T r over all vectors, with r = rows_of(vectors) bordered by a
    1 (so the last row holds the sums of r and of the weights).  Partial matrices
    leave tasks row by row and are added in the order of their partitions."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for x, weight in blocks(batches, dim):
            r = rows_of(x)
            r = np.concatenate([r, np.ones((len(r), 1))], axis=1)
            part = (r * weight[:, None]).T @ r
            total = part if total is None else total + part
        if total is not None:
            own = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([own] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()),
                                              pa.array(list(total), pa.list_(pa.float64()))], names=["part", "i", "row"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.stack(pdf.sort_values("part")["row"].to_list())
        return pd.DataFrame({"i": pdf["i"][:1], "row": [rows.sum(axis=0)]})

    parts = distinct.select("x", "weight").mapInArrow(partial, "part int, i int, row array<double>")
    rows = parts.groupBy("i").applyInPandas(add, "i int, row array<double>").collect()  # dim + 1 rows
    return np.array([r["row"] for r in sorted(rows, key=lambda r: r["i"])]).reshape(-1, len(rows))


def centred_covariance(m: np.ndarray) -> np.ndarray:
    """The covariance (divisor: all weight) of a bordered product."""
    weight, sums = m[-1, -1], m[-1, :-1]
    return m[:-1, :-1] / weight - np.outer(sums, sums) / weight**2


def fit(distinct: DataFrame, dim: int, components: int = COMPONENTS) -> Fit:
    """Fit to ``distinct`` (x, weight): exact totals first, then the covariance of
    the centred vectors, then its eigenvectors by falling eigenvalue."""
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, weight in blocks(batches, dim):
            if int(np.abs(x).max(initial=0)) * int(weight.max(initial=0)) * len(x) < 1 << 62:
                sums = (x * weight[:, None]).sum(axis=0).tolist()
            else:
                sums = (x.astype(object) * weight[:, None].astype(object)).sum(axis=0)
            values = [str(v) for v in [*sums, int(weight.sum())]]
            yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()), pa.array(values, pa.string())], names=["i", "part"])

    parts = distinct.select("x", "weight").mapInArrow(totals, "i int, part string")
    found = {r["i"]: int(r["s"]) for r in parts.groupBy("i").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect()}  # dim + 1 rows
    n, sums = found[dim], [found[i] for i in range(dim)]
    bare = Fit(n, sums, np.ones(dim), np.eye(dim), 0.0)
    cov = centred_covariance(product(distinct, dim, bare.centred))
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > max(values[0], 0.0) * FLAT * dim
    keep = np.flatnonzero(real)[:components]
    return Fit(n, sums, values[keep], vectors[:, keep], float(np.trace(cov)))


RESULT = "x array<long>, copies long, deviation decimal(38,0), whitened array<double>"


def whiten(rows: DataFrame, vector: str, components: int = COMPONENTS, counts: bool = False) -> DataFrame:
    """Each remaining row of ``rows`` as a struct ``row``, with n, deviation,
    whitened (an array, one entry a component), explained (an array), and
    identity_error: the largest absolute entry of the whitened vectors'
    covariance minus the identity.  Vectors weigh one each, or with ``counts`` as
    much as they have rows."""
    held = boxed(rows).withColumn("x", on_grid(F.col(f"row.`{vector}`"))).where("x IS NOT NULL AND size(x) > 0")
    spark = rows.sparkSession
    grouped = stash(held.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "vectors")
    lengths = grouped.groupBy(F.size("x").alias("dim")).agg(F.sum("copies").alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("dim")).first()
    shape = "row struct<>, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if most is None:
        return spark.createDataFrame([], shape.replace("struct<>", boxed(rows).schema["row"].dataType.simpleString()))
    dim = most["dim"]
    weight = F.col("copies") if counts else F.lit(1).cast("long")
    distinct = grouped.where(F.size("x") == dim).withColumn("weight", weight)
    model = fit(distinct, dim, components)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for x, copies in blocks(batches, dim):
            dev = [Decimal(v) for v in deviations(x, model.n, model.sums)]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.int64())), pa.array(copies, pa.int64()), pa.array(dev, pa.decimal128(38, 0)),
                                              pa.array(list(model.whitened(x)), pa.list_(pa.float64()))], names=["x", "copies", "deviation", "whitened"])

    k = len(model.values)
    error = float(np.abs(centred_covariance(product(distinct, dim, model.whitened)) - np.eye(k)).max()) if k else 0.0
    once = stash(distinct.select("x", F.col("copies").alias("weight")).mapInArrow(apply, RESULT), "whitened")
    back = join_groups(held.where(F.size("x") == dim), once, "x", "copies", most["rows"])
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values]) if k else F.array().cast("array<double>")
    return back.select("row", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))
