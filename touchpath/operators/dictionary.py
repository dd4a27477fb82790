"""Dictionary evaluation: a costly label is computed once per distinct tuple.

Rules over a few columns (patterns of source, medium and campaign) see far fewer
distinct tuples than rows.  Their labels are computed on the distinct tuples, written
as a table to the shared folder, and joined back with NULL-safe keys.

The table's size is measured when it is written.  Up to ``BROADCAST_BYTES`` it is sent
to the executors and the rows are not shuffled; beyond that the join shuffles both
sides.  There the rows of one frequent tuple would meet in one partition, so each row
takes one of ``SALTS`` places by a hash of all it holds (the same on every attempt) and
the tuples are repeated for each place; rows alike in every column are left to AQE's
skew split.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.session import scratch_path
from touchpath.sources.sinks import remove

#: A dictionary is broadcast up to this size (bytes of its texts, 32 a row added).
BROADCAST_BYTES = 16 << 20
SALTS = 64


class Dictionary:
    """Labels of the distinct tuples of ``cols`` in ``rows``; ``label`` makes the
    label column out of the tuple's columns.  Building it runs a job; ``close`` (or
    the end of a ``with`` block) removes its table."""

    def __init__(self, rows: DataFrame, cols: list[str], label: Callable[..., Column]) -> None:
        self.cols, self.spark = cols, rows.sparkSession
        self._keys = [f"__k{i}" for i in range(len(cols))]
        tuples = rows.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(cols, self._keys)]).distinct()
        labelled = tuples.select(*self._keys, label(*[F.col(k) for k in self._keys]).alias("__label"))
        self.path = scratch_path(self.spark, "dictionary")
        labelled.write.parquet(self.path)
        self._table = self.spark.read.schema(labelled.schema).parquet(self.path)
        text = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in [*self._keys, "__label"]])
        self.tuples, size = self._table.agg(F.count(F.lit(1)), F.coalesce(F.sum(text + F.lit(32)), F.lit(0))).first()
        self.small = size <= BROADCAST_BYTES

    def apply(self, rows: DataFrame, out: str) -> DataFrame:
        """``rows`` with ``out``: the label of their tuple (NULL for a tuple that the
        dictionary was not built from)."""
        names = [F.col(f"`{c}`") for c in rows.columns if c != out]
        table = self._table
        if self.small:
            left, table, keys = rows, F.broadcast(table), []
        else:
            known = [F.col(f"`{f.name}`") for f in rows.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
            place = F.pmod(F.xxhash64(*known), F.lit(SALTS)).cast("int")
            left, keys = rows.withColumn("__place", place), [F.col("__place") == F.col("__at")]
            table = table.withColumn("__at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        on = [F.col(f"`{c}`").eqNullSafe(F.col(k)) for c, k in zip(self.cols, self._keys)]
        return left.join(table, reduce(lambda a, b: a & b, on + keys), "left").select(*names, F.col("__label").alias(out))

    def close(self) -> None:
        remove(self.spark, self.path)

    def __enter__(self) -> "Dictionary":
        return self

    def __exit__(self, *exc) -> None:
        self.close()
