"""A training-data pipeline over ``documents``: language identification, exact
dedup, near dedup, mixing to target weights, packing.

Each stage takes what its predecessor kept, written as Parquet in the shared
folder, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.llm import common, exact_dedup, langid, minhash, mixing, packing
from touchpath.sources.sinks import remove


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified: texts without a letter go, and
    those whose best language stays below the calibrated threshold."""
    rows = common.boxed(docs).select("row", F.col("row.text").alias("text"))
    return langid.identify(rows, langid.fit(docs)).where("NOT rejected").select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for the case of A-Z), the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the least
    doc_id stays."""
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.resample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_identified),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The learned model, the dual's iterations and the packing search have no SQL;
#: tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        # a stage's intermediate tables go when its result is written, and that
        # result when the next one is
        with common.scratch(spark):
            docs, made = common.written(stage(spark, docs, sf_dir), name)
        if last:
            remove(spark, last)
        last = made
    return STAGES[-1][1](spark, docs, sf_dir)
