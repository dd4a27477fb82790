"""As-of scan: the last value before each row of the same key.

Rows are dealt once, by ranges of (key, time), and sorted inside a range; one pass
carries the last value along.  A key of any size is cut by the ranges themselves,
which are drawn from a sample of the rows.  What a range needs from the ranges
before it is a single row, the last one with a value: as rows are in order, the
value before a range's first rows can only be that one.  So the carried-in values
are as many rows as there are ranges; they are read off the same exchange.  Should
a session plan that exchange twice (``spark.sql.exchange.reuse`` switched off), whose
ranges may then differ, the result is an error, never a wrong value: each range's
first row is compared.

The pass handles Arrow batches with array operations, and holds a batch and at
most two carried rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.session import shuffle_width

# the pass travels to the executors by value: workers need pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RANGE, _LAST = "__range", "__last"


def _changes(column: pa.Array) -> np.ndarray:
    """Whether a row's value differs from the row before it (null equals null)."""
    if len(column) < 2:
        return np.ones(len(column), bool)
    a, b = column[1:], column[:-1]
    differ = pc.if_else(pc.or_(pc.is_null(a), pc.is_null(b)), pc.xor(pc.is_null(a), pc.is_null(b)), pc.not_equal(a, b))
    return np.concatenate([[True], differ.to_numpy(zero_copy_only=False).astype(bool)])


def _scanner(by: int, at: int, value: int, names: list[str], within: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pass over one range; ``by``, ``at`` and ``value`` are column numbers."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, opens = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([pa.RecordBatch.from_arrays([batch.column(i) for i in (by, at, value)], names=["by", "at", "value"])])
            before = 0 if carried is None else carried.num_rows
            if before:
                rows = pa.concat_tables([carried, rows])
            rows = rows.combine_chunks()
            key, time, values = (rows.column(i).combine_chunks() for i in range(3))
            n = len(rows)
            place = np.arange(n)
            untimed = time.is_null().to_numpy(zero_copy_only=False)
            clock = time.fill_null(0).to_numpy(zero_copy_only=False)
            new_key = _changes(key)
            new_time = new_key | _changes(time)
            first = np.maximum.accumulate(np.where(new_key, place, 0))
            tie = np.maximum.accumulate(np.where(new_time, place, 0))
            valued = np.maximum.accumulate(np.where(values.is_valid().to_numpy(zero_copy_only=False) & ~untimed, place, -1))
            # the last row with a value before all rows of this time
            found = np.where(tie > 0, valued[tie - 1], -1)
            ok = (found >= first) & ~untimed & (clock - clock[found] <= within)
            last = values.take(pa.array(np.where(ok, found, 0), mask=~ok))[before:]
            end = n - 1
            kept = sorted({int(i) for i in (found[end], valued[end]) if i >= first[end]})
            carried = rows.take(pa.array(kept, pa.int64())) if kept else None
            start = np.zeros(batch.num_rows, bool)
            start[0], opens = opens, False
            yield pa.RecordBatch.from_arrays([*batch.columns, last, pa.array(start)], names=names)

    return scan


def _ender(by: int, at: int, value: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Key and time of the first row of one range, and its last row with a value
    (and a time), if there is one."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            first = batch.slice(0, 1) if first is None else first
            ok = pc.and_(batch.column(value).is_valid(), batch.column(at).is_valid()).to_numpy(zero_copy_only=False)
            if ok.any():
                last = batch.slice(int(np.flatnonzero(ok)[-1]), 1)
        if first is not None:
            end = [(pa.nulls(1, first.column(i).type) if last is None else last.column(i)) for i in (by, at, value)]
            yield pa.RecordBatch.from_arrays([first.column(first.num_columns - 1), first.column(by), first.column(at), *end], names=names)

    return scan


def last_before(df: DataFrame, by: str, at: str, tie: str, value: str, out: str, within: int, ranges: int | None = None) -> DataFrame:
    """``df`` with ``out``: the non-NULL ``value`` of the latest row of the same
    ``by`` (NULL is a key, too) whose ``at`` lies 1 to ``within`` earlier; of several
    such rows at one time, the one with the greatest ``tie``.  A row without ``at``
    gets none and gives none."""
    n = ranges or shuffle_width(df.sparkSession)
    # equal (key, time) stay in one range, so a value of a range before is earlier
    # (the expression numbers the exchange's own partitions; a task's number would
    # count those of other branches of a union, too)
    dealt = df.repartitionByRange(n, by, at).withColumn(_RANGE, F.spark_partition_id()).sortWithinPartitions(by, at, tie)
    nulls = lambda fields: T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    own = {c: df.columns.index(c) for c in (by, at, value)}
    kind = df.schema[value].dataType
    scanned = nulls([*df.schema.fields, T.StructField(_RANGE, T.IntegerType()), T.StructField(out, kind), T.StructField("__opens", T.BooleanType())])
    key, time = df.schema[by].dataType, df.schema[at].dataType
    ended = nulls([T.StructField(_RANGE, T.IntegerType()), T.StructField("__first_by", key), T.StructField("__first_at", time),
                   T.StructField("__by", key), T.StructField("__at", time), T.StructField("__value", kind)])
    rows = dealt.mapInArrow(_scanner(own[by], own[at], own[value], scanned.names, within), scanned)
    ends = dealt.mapInArrow(_ender(own[by], own[at], own[value], ended.names), ended)
    # one row per range at most, so one task orders them
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    spine = df.sparkSession.range(n).select(F.col("id").cast("int").alias(_RANGE))
    carried = spine.join(F.broadcast(ends), _RANGE, "left").select(
        _RANGE, "__first_by", "__first_at",
        F.last(F.when(F.col("__at").isNotNull(), F.struct("__by", "__at", "__value")), ignorenulls=True).over(before).alias(_LAST))
    reach = F.col(_LAST)["__by"].eqNullSafe(F.col(by)) & (F.col(at) - F.col(_LAST)["__at"] <= within)
    both = rows.join(F.broadcast(carried), _RANGE, "left")
    other = F.col("__opens") & ~(F.col("__first_by").eqNullSafe(F.col(by)) & F.col("__first_at").eqNullSafe(F.col(at)))
    found = F.coalesce(F.col(out), F.when(reach, F.col(_LAST)["__value"]))
    checked = F.when(other, F.raise_error(F.lit("the as-of scan's exchange was planned twice: spark.sql.exchange.reuse has to be on"))).otherwise(found)
    return both.select(*df.columns, checked.alias(out))
