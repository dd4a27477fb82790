"""Spark session defaults and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on.  UTC keeps date(ts) stable across hosts;
# ANSI stays on; AQE re-plans joins (runtime broadcast of small sides whose
# shuffle output is measured, skew-join splitting of hot partitions) and
# coalesces small shuffle partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # the attribution plans generate many distinct classes; with the default
    # 100-entry cache they evict each other and are compiled again
    "spark.sql.codegen.cache.maxEntries": "2000",
}

# Runtime SQL settings applied to any session the library is handed (they can
# be changed after start-up).
RUNTIME_SQL = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only what was measured: no broadcast from planning-time size
    # estimates; AQE broadcasts a join side once its shuffle output is known
    # to be under 10 MB
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_SQL.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


#: Input rows for which a shuffle gets one partition at first.
SHUFFLE_ROWS = 250_000
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Let shuffles begin with a partition per :data:`SHUFFLE_ROWS` input rows.

    With a fixed number, a task's sorts grow with the input.  The adaptive plan
    merges what is small up to its advisory size, so that size bounds a task.  The
    number is only ever raised, also above ``spark.sql.shuffle.partitions``: plans
    handed out earlier may still run.
    """
    need = -(-rows // SHUFFLE_ROWS)
    if need > shuffle_width(spark):
        spark.conf.set(INITIAL_PARTITIONS, str(need))


def shuffle_width(spark: SparkSession) -> int:
    """Partitions with which a shuffle begins; for those that name their number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(INITIAL_PARTITIONS, None) or 0))


def get_session(master: str | None = None, app: str = "touchpath",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without it (tests): a private folder is created
    and registered as the checkpoint dir.  Any other master needs the setting,
    since a folder of the driver's own disk is not seen by its executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no context
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else "remote"
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"master {master}: set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="touchpath-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
    elif sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    if "://" not in root:
        os.makedirs(root, exist_ok=True)
    return f"{root}/touchpath/{name}-{uuid.uuid4().hex[:12]}"
