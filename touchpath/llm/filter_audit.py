"""Audit of interacting filters by the Hart-Mas-Colell potential.

A part (say, a source) plays the removal game: a coalition of filters is worth
the documents that fail at least one of them.  All a game needs are the counts
of documents by the set of filters they fail (a mask of one bit a filter), which
Spark aggregates; with five filters that is at most 32 counts a part.

The potential of the empty coalition is 0, and that of a coalition S is

    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,

computed coalition by coalition in one row per part.  A filter's Shapley value
is the potential of all filters minus the potential without that one.  Applying
filters in an order removes, at each step, the value of the coalition so far
minus that of the coalition before it; no order is replayed on documents.

Potentials are held in units of 1 / n! for n filters, which makes them whole
numbers: a Shapley value in this unit is the sum over all orders.

Defined results: null text is empty; a null part is the empty string; a null
doc_id has no label and is no smaller and no larger than any other; repeated
rows are documents each (equal doc_ids are not smaller than each other); a
document with several labels is good or toxic if any of them says so; null
labels say nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchpath.llm.common import stash

#: The text filters, by letter and bit; E, the identical text, comes behind them.
TEXT_FILTERS = "ABCD"
FILTERS = TEXT_FILTERS + "E"

LEAST_WORDS = 50
#: Least distinct words and most capitals, in per cent.
DISTINCT_PERCENT, CAPITAL_PERCENT = 65, 5
CAPITALS = bytes(range(0x41, 0x5B))
SIGNS = b"#$%&*|"


def failures(text: str) -> int:
    """Bit i: the text fails ``TEXT_FILTERS[i]``."""
    raw = text.encode()
    words = raw.split()  # at \x20 and \x09 to \x0D
    n = len(words)
    few = n < LEAST_WORDS
    dull = 100 * len(set(words)) < DISTINCT_PERCENT * n
    loud = 100 * (len(raw) - len(raw.translate(None, CAPITALS))) > CAPITAL_PERCENT * len(text)
    odd = len(raw.translate(None, SIGNS)) < len(raw)
    return few | dull << 1 | loud << 2 | odd << 3


@F.arrow_udf(T.StructType([T.StructField("fails", T.IntegerType()), T.StructField("digest", T.BinaryType())]))
def look(text: pa.Array) -> pa.Array:
    """The filters that each whole text fails, and its 128-bit digest."""
    fails, digests = [], []
    for t in text:
        t = t.as_py() or ""
        fails.append(failures(t))
        digests.append(hashlib.blake2b(t.encode(), digest_size=16).digest())
    return pa.StructArray.from_arrays([pa.array(fails, pa.int32()), pa.array(digests, pa.binary())], names=["fails", "digest"])


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters they
    fail, of ``docs`` (doc_id, text, part) and ``labels`` (doc_id, quality, toxic).

    Copies are counted per (text, part, labels) before the texts' least doc_ids
    are joined, so a text with any number of copies is a few rows there.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"),
                       look(F.col("text").cast("string")).alias("seen"))
    rows = rows.groupBy("doc_id", "part", "seen.digest", "seen.fails").agg(F.count(F.lit(1)).alias("n"))
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(out) for c, out in (("quality", "good"), ("toxic", "toxic"))])
    # a null doc_id has no label: the salt spreads such rows over all partitions
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.col("doc_id"))
    rows = rows.withColumn("_salt", salt).join(said.withColumn("_salt", F.col("doc_id")).drop("doc_id"), "_salt", "left")
    rows = rows.withColumns({c: F.col("doc_id").isNotNull() & F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # copies of a text with one part and labels: how many, and how many at the least doc_id
    copies = rows.groupBy("digest", "fails", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("low"), F.min_by("n", "doc_id").alias("at_low"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnumbered"))
    copies = stash(copies, "copies")
    first = copies.groupBy("digest").agg(F.min("low").alias("first"))
    both = copies.join(first, "digest")
    original = F.col("unnumbered") + F.when(F.col("low") == F.col("first"), F.col("at_low")).otherwise(0)
    each = F.array(F.struct(F.col("fails").alias("mask"), original.alias("n")),
                   F.struct(F.col("fails").bitwiseOR(F.lit(1 << len(TEXT_FILTERS))).alias("mask"), (F.col("n") - original).alias("n")))
    flat = both.select("part", "good", "toxic", F.explode(each).alias("e")).select("part", "good", "toxic", "e.*").where("n > 0")
    count = lambda flag, out: F.sum(F.when(F.col(flag), F.col("n")).otherwise(0)).alias(out)
    return flat.groupBy("part", "mask").agg(F.sum("n").alias("n"), count("good", "good"), count("toxic", "toxic"))


def coalition_values(counts: DataFrame, filters: int) -> DataFrame:
    """One row per part: n (all documents) and the arrays v, good, toxic, whose
    entry S is what the coalition S (a mask) removes."""
    def value(col: str, s: int) -> Column:
        return F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(col)).otherwise(F.lit(0)))

    game = lambda col, out: F.array(*[value(col, s) for s in range(1 << filters)]).alias(out)
    return counts.groupBy("part").agg(F.sum("n").alias("n"), game("n", "v"), game("good", "good"), game("toxic", "toxic"))


def potentials(v: Column, filters: int) -> Column:
    """The array of n! * P(S), by the recursion over coalitions: a coalition
    without one of its filters has a smaller mask, so it is there already."""
    unit = math.factorial(filters)

    def step(done: Column, s: Column) -> Column:
        below = sum((F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.get(done, s.bitwiseXOR(F.lit(1 << i)))).otherwise(F.lit(0)) for i in range(filters)), F.lit(0).cast("long"))
        # n! * P(S) is a whole number, so the division leaves no rest
        return F.concat(done, F.array(F.call_function("div", F.get(v, s) * unit + below, F.bit_count(s).cast("long"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << filters) - 1)), F.array(F.lit(0).cast("long")), step)


def audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """Every step of every order of the filters ``names`` (a letter a bit), of
    ``counts`` (part, mask, n, good, toxic): columns part, filter_order, step,
    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley (the
    last one summed over all orders)."""
    k = len(names)
    game = coalition_values(counts, k).withColumn("p", potentials(F.col("v"), k))
    # orders, with the coalition before each step and the filter that joins it
    steps = []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            steps.append(F.struct(F.lit("".join(names[i] for i in order)).alias("filter_order"), F.lit(step).alias("step"),
                                  F.lit(before).alias("before"), F.lit(1 << f).alias("own")))
            before |= 1 << f
    rows = game.withColumn("s", F.explode(F.array(*steps))).select("part", "n", "v", "good", "toxic", "p", "s.*")
    everyone = (1 << k) - 1
    now = F.col("before").bitwiseOR(F.col("own"))
    rest = F.lit(everyone).bitwiseXOR(F.col("own"))
    gain = lambda c: F.get(c, now) - F.get(c, F.col("before"))
    return rows.select("part", "filter_order", "step", (F.col("n") - F.get("v", now)).alias("kept"), gain("v").alias("removed"),
                       (F.get("v", F.col("own")) - gain("v")).alias("redundant"), (F.get("v", F.lit(everyone)) - F.get("v", rest)).alias("unique_fails"),
                       gain("good").alias("good_lost"), gain("toxic").alias("toxic_lost"),
                       (F.get("p", F.lit(everyone)) - F.get("p", rest)).alias("shapley"))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five document filters: ``docs`` has doc_id, text, part;
    ``labels`` doc_id, quality, toxic; further columns are not read."""
    return audit(masks(docs, labels))
