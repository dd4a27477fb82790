"""Analytics event export readers (date-sharded or date-partitioned)."""

from __future__ import annotations

from datetime import date
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.functions.dates import shard_date
from touchpath.sources.sampling import sampled_files


#: The export's columns, as far as the models read them (FIXTURES 1.1).
EXPORT_SCHEMA = """
    event_date string, event_timestamp bigint, event_name string,
    event_params array<struct<key: string, value: struct<string_value: string, int_value: bigint, float_value: double, double_value: double>>>,
    user_id string, user_pseudo_id string,
    device struct<category: string, web_info: struct<hostname: string>>,
    stream_id string, items array<struct<item_id: string>>, ecommerce struct<transaction_id: string>"""


def _ymd(d: date) -> str:
    return d.strftime("%Y%m%d")


def _list_shards(spark: SparkSession, pattern: str) -> list[str]:
    """Expand a Hadoop glob on the driver (directory listing only)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(path) or []
    return sorted(str(s.getPath().toString()) for s in found if s.isDirectory())


def read_ga4_shards(spark: SparkSession, root: str, days: Iterable[date] | None = None,
                    prefer_daily: bool = False, schema=None, missing: str = "raise",
                    sample_percent: float | None = None, seed: int = 42, sample_unit: str = "file") -> DataFrame:
    """Read ``events_YYYYMMDD`` / ``events_intraday_YYYYMMDD`` shard folders.

    Only the folders of the wanted ``days`` are listed (true pruning: other
    shards are never opened).  ``shard_date`` comes from the folder name, so an
    intraday shard counts as its day.  A day present as daily and intraday is
    read twice unless ``prefer_daily`` drops the intraday copy.  A known
    ``schema`` (StructType or DDL string) skips schema inference, which would
    drop columns that the sampled shard happens not to have.

    A wanted day without a shard raises, as a reload would empty that day's
    stored partition.  ``missing='leading'`` lets days before the first shard be
    absent (an export that began inside the window), ``'allow'`` any.

    ``sample_percent`` reads a seeded sample of the shards' files alone (or of their
    sub-folders, ``sample_unit='folder'``); the others cost no reading.
    """
    if missing not in ("raise", "leading", "allow"):
        raise ValueError(missing)
    root = root.rstrip("/")
    if days is None:
        pattern = f"{root}/*events_*"
    else:
        days = sorted(set(days))
        if not days:
            raise ValueError("no shard days requested")
        pattern = f"{root}/*events_{{,intraday_}}{{{','.join(_ymd(d) for d in days)}}}"
    paths = _list_shards(spark, pattern)
    if prefer_daily:
        daily = {p.rsplit("events_", 1)[1] for p in paths if "events_intraday_" not in p}
        paths = [p for p in paths
                 if "events_intraday_" not in p or p.rsplit("events_intraday_", 1)[1] not in daily]
    if not paths:
        raise FileNotFoundError(f"no event shards match {pattern}")
    if days is not None and missing != "allow":
        have = {p.rstrip("/")[-8:] for p in paths}
        absent = [d for d in days if _ymd(d) not in have and (missing == "raise" or _ymd(d) > min(have))]
        if absent:
            raise FileNotFoundError(f"no event shard of {', '.join(d.isoformat() for d in absent)} in {root}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if sample_percent is not None:
        paths = sampled_files(spark, paths, sample_percent, seed, sample_unit) or paths
    df = reader.parquet(*paths)
    return df.withColumn("shard_date", shard_date(F.col("_metadata.file_path")))


def write_ga4_shards(df: DataFrame, root: str, intraday_days: Iterable[date] = (), by_hour: bool = False) -> None:
    """Write an export as one shard folder per day (``shard=events_YYYYMMDD``), with
    a sub-folder per hour of the event time where ``by_hour``.

    One write job: the shard name is a partition value, so Spark fans rows out
    to folders in parallel; the rebalance spreads a large day over several
    writer tasks.
    """
    intraday = [F.lit(d) for d in intraday_days]
    name = F.concat(
        F.lit("events_"),
        F.when(F.col("shard_date").isin(intraday), F.lit("intraday_")).otherwise(F.lit("")) if intraday else F.lit(""),
        F.date_format("shard_date", "yyyyMMdd"))
    keys = ["shard", "hour"] if by_hour else ["shard"]
    if by_hour:
        df = df.withColumn("hour", (F.floor(F.col("event_timestamp") / 3_600_000_000) % 24).cast("int"))
    (df.withColumn("shard", name).drop("shard_date")
       .hint("rebalance", *keys)
       .write.mode("overwrite").partitionBy(*keys).parquet(root))
