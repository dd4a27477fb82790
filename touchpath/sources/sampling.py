"""Development sampling of a source table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.config import DEV, RunConfig

#: Columns that name an event, whose hash decides.
EVENT_KEY = ("event_timestamp", "event_name", "user_id", "user_pseudo_id")


def in_sample(cfg: RunConfig, key: tuple[str, ...] = EVENT_KEY) -> Column:
    """True for ``dev_sample_percent`` % of the keys: the first 32 bits of the
    key's MD5 (with the seed), in parts of 10,000.  It depends on the event
    alone, not on files or partitions."""
    text = F.concat_ws("|", F.lit(str(cfg.sample_seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    place = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % 10_000
    return place < F.lit(int(cfg.dev_sample_percent * 100))


def dev_sample(df: DataFrame, cfg: RunConfig, force: bool = False) -> DataFrame:
    """``dev_sample_percent`` % of the events in dev runs, chosen by hash inside
    each scan task (no shuffle).  It reads all events; with
    ``dev_sampling='blocks'`` the reader has sampled whole files instead
    (:func:`sampled_files`), and all their events stay."""
    if not force and (cfg.mode != DEV or cfg.dev_sampling == "blocks"):
        return df
    return df.where(in_sample(cfg))


# --- whole files --------------------------------------------------------------

def data_files(spark: SparkSession, folders: list[str]) -> list[tuple[str, str]]:
    """(name, path) of every data file below ``folders``, from listings on the
    driver; a name is the path from the folder's own name on."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for folder in folders:
        root = jvm.org.apache.hadoop.fs.Path(folder)
        found = root.getFileSystem(conf).listFiles(root, True)
        top = str(root.toUri().getPath()).rstrip("/")
        base = top.rpartition("/")[0]
        while found.hasNext():
            path = found.next().getPath()
            name = str(path.toUri().getPath())[len(base) + 1:]
            if not any(part.startswith(("_", ".")) for part in name.split("/")[1:]):
                out.append((name, str(path.toString())))
    return sorted(out)


def block_place(name: str, seed: int) -> int:
    """Place of a block among 10,000: the first 32 bits of the MD5 of its name."""
    return int(hashlib.md5(f"{seed}|{name}".encode()).hexdigest()[:8], 16) % 10_000


def sampled_files(spark: SparkSession, folders: list[str], percent: float, seed: int, unit: str = "file") -> list[str]:
    """Files below ``folders`` of a sample of blocks, ``percent`` % of them: the others
    are never opened.  A block is a file, or (``unit='folder'``) a folder of files
    such as an hour of a shard.  It is chosen by the hash of its name, so a sample is
    the same on every run, and a smaller one lies inside a larger one; at least one
    block is read where there is any."""
    if unit not in ("file", "folder"):
        raise ValueError(unit)
    blocks: dict[str, list[str]] = {}
    for name, path in data_files(spark, folders):
        blocks.setdefault(name if unit == "file" else name.rpartition("/")[0], []).append(path)
    if not blocks:
        return []
    places = {name: block_place(name, seed) for name in blocks}
    least = min(places, key=lambda name: (places[name], name))
    chosen = [name for name in sorted(blocks) if places[name] < percent * 100 or name == least]
    return [path for name in chosen for path in blocks[name]]
