"""Date-partitioned sinks: full rebuild, dynamic and static partition
overwrite, schema guard and the high-water mark of a target.

Files are laid out as ``<path>/<partition_col>=YYYY-MM-DD/part-*.parquet``.
Before writing, rows are rebalanced on the date (the ``REBALANCE`` hint: a
hash shuffle on the date whose oversized partitions AQE splits into
advisory-size pieces and whose small ones it merges, so a hot date is written
by several tasks and no sampling job re-runs the upstream plan) and sorted by
(date, cluster keys) within each task, so row-group min/max statistics skip
most row groups for a key lookup.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession


class OutsidePartitionsError(ValueError):
    """A static overwrite got rows outside its list of partitions."""


class SchemaChangeError(ValueError):
    """The incoming schema differs from the target's (policy: fail)."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files of a folder."""
    fs, p = _fs(spark, path)
    names = [str(s.getPath().getName()) for s in fs.listStatus(p) if s.isFile()]
    return [n for n in names if not n.startswith(("_", "."))]


def _sibling(path: str, kind: str) -> str:
    """A fresh folder beside ``path``: on the target's own storage, so every
    executor sees it and a rename moves no data."""
    head, _, tail = path.rstrip("/").rpartition("/")
    return f"{head}/{tail}-{kind}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


@contextmanager
def staging(spark: SparkSession, path: str, kind: str):
    """A sibling folder of ``path`` that is gone afterwards, also on failure."""
    tmp = _sibling(path, kind)
    try:
        yield tmp
    finally:
        remove(spark, tmp)


def _layout(df: DataFrame, partition_by: str | None, cluster_by: list[str] | None) -> DataFrame:
    keys = ([partition_by] if partition_by else []) + list(cluster_by or [])
    if not keys:
        return df
    spread = df.hint("rebalance", partition_by) if partition_by else df.hint("rebalance")
    return spread.sortWithinPartitions(*keys)


def check_schema(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Raise when ``df`` would change the column names or types of ``path``."""
    if not exists(spark, path):
        return
    old = [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(path).schema.fields]
    new = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if sorted(old) != sorted(new):
        raise SchemaChangeError(f"schema change refused for {path}: {sorted(set(old) ^ set(new))}")


def write_full(df: DataFrame, path: str, partition_by: str | None = "event_date_dt",
               cluster_by: list[str] | None = None, guard_schema: bool = False) -> None:
    """Full rebuild: the target is replaced as a whole.

    The new table is written beside the target and moved into its place when it
    is complete, so a failed rebuild leaves the old table as it was.
    """
    spark = df.sparkSession
    if guard_schema:
        check_schema(spark, df, path)
    with staging(spark, path, "new") as new, staging(spark, path, "old") as old:
        w = _layout(df, partition_by, cluster_by).write
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(new)
        fs, target = _fs(spark, path)
        there, made, kept = (_fs(spark, x)[1] for x in (path, new, old))
        had = fs.exists(target)
        if had and not fs.rename(there, kept):
            raise OSError(f"{path} cannot be moved aside")
        if not fs.rename(made, target):
            if had:
                fs.rename(kept, target)
            raise OSError(f"the new table cannot be moved to {path}")
    spark.catalog.refreshByPath(path)


def _observed(df: DataFrame, observe) -> DataFrame:
    """``df`` as it is written, with the metrics of ``observe`` (an Observation and
    its columns) taken from the rows of the write's last stage."""
    return df if observe is None else df.observe(observe[0], *observe[1])


def write_dynamic(df: DataFrame, path: str, partition_by: str = "event_date_dt",
                  cluster_by: list[str] | None = None, guard_schema: bool = False,
                  stage: bool = False, observe=None) -> None:
    """Replace the partitions present in ``df``; all others stay.

    ``stage=True`` first writes ``df`` beside the target, which is needed when
    ``df`` reads the target itself.
    """
    spark = df.sparkSession
    if guard_schema:
        check_schema(spark, df, path)

    def put(rows: DataFrame) -> None:
        (_observed(_layout(rows, partition_by, cluster_by), observe).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))

    if not stage:
        put(df)
        return
    with staging(spark, path, "stage") as tmp:
        df.write.partitionBy(partition_by).parquet(tmp)
        put(spark.read.schema(df.schema).parquet(tmp))


#: Folder name of rows without a partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_name(col: str, day: date | None) -> str:
    return f"{col}={NULL_PARTITION if day is None else day.isoformat()}"


def partition_days(spark: SparkSession, path: str, col: str) -> list[date | None]:
    """The partition dates of a folder (None: rows without one), from its listing."""
    if not exists(spark, path):
        return []
    fs, root = _fs(spark, path)
    prefix = f"{col}="
    names = [str(st.getPath().getName()) for st in fs.listStatus(root) if st.isDirectory()]
    values = [n[len(prefix):] for n in names if n.startswith(prefix)]
    return [None if v == NULL_PARTITION else date.fromisoformat(v) for v in values]


def write_static(spark: SparkSession, df: DataFrame, path: str, partition_by: str,
                 partitions: list[date | None], cluster_by: list[str] | None = None,
                 guard_schema: bool = False, observe=None) -> None:
    """Replace exactly the listed partitions, even when ``df`` has no row for one.

    ``df`` is staged once (its lineage is cut there); the staged partitions
    replace their targets, and listed partitions missing from the stage are
    removed from the target.  Rows outside the list are an error, found before
    the target is touched: they would replace a partition by the few of its
    rows that are in ``df``.
    """
    if guard_schema:
        check_schema(spark, df, path)
    listed = {partition_name(partition_by, d) for d in partitions}
    with staging(spark, path, "stage") as tmp:
        _observed(df, observe).write.partitionBy(partition_by).parquet(tmp)
        fs, tp = _fs(spark, tmp)
        staged = {str(s.getPath().getName()) for s in fs.listStatus(tp) if s.isDirectory()}
        staged = {n for n in staged if n.startswith(f"{partition_by}=")}
        if staged - listed:
            raise OutsidePartitionsError(f"static overwrite of {path} got rows outside its partitions: {sorted(staged - listed)}")
        if staged:
            write_dynamic(spark.read.schema(df.schema).parquet(tmp), path, partition_by, cluster_by)
    for name in sorted(listed - staged):
        remove(spark, f"{path.rstrip('/')}/{name}")


def high_water_mark(spark: SparkSession, path: str, col: str = "event_date_dt") -> date | None:
    """Largest partition date of a target (None when it does not exist yet).

    Read from the partition folder names (a directory listing on the driver),
    so no Spark job runs and no file is opened.
    """
    days = [d for d in partition_days(spark, path, col) if d is not None]
    return max(days) if days else None
