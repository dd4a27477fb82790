"""Mixing sources to target weights by entropy balancing.

Every document gets a rate: the rates stay as close as possible to 1 (least
relative entropy) while each source's taken words meet its target and no rate
passes the cap.  Then the rate of a document of ``size`` words is
``min(cap, exp(lambda * size / mean))`` with one multiplier per source, the
root of a convex dual.  Newton steps, kept inside a bracket, find it: each step
is one grouped sum over (source, size, documents) counts, the exact statistics
of the problem, as documents of one source and size share a rate.

Rates become copies by cumulative rounding: documents of a source are lined up
by size, and each takes as many copies as whole numbers lie in its stretch of the
running sum of rates; so the words taken differ from the target by about the
largest document at most.  All sums are exact (integers and decimals), so reruns
agree whatever the order of rows.

Defined results: null text has size 0; a null source is a source of its own,
last; a document without words has copies but takes no words; repeated rows are
documents like others; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchpath.llm.common import boxed, count_words, numbered, same, stash

#: No document is taken more often than this, and no source's target passes
#: this multiple of its words.
CAP = 3
#: Rates are held in units of 1 / UNIT.
UNIT = 1_000_000_000
#: Newton steps end at this relative error of every source's words.
TOLERANCE = 1e-9
MAX_STEPS = 80


def targets(counts: DataFrame) -> DataFrame:
    """(source, source_size, mean, target): sources by code point, null last,
    weigh 1, 2, 3, repeating; what passes the cap is reshared by weight."""
    per = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
    # a source is held at its cap if its share of what the sources before it
    # (by cap per weight) leave passes the cap; those form a prefix
    line = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = line.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    exact = "decimal(38,0)"
    left = F.sum("source_size").over(every).cast(exact) - F.coalesce(F.sum("source_size").over(before), F.lit(0)).cast(exact) * CAP
    weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.withColumn("_left", left).withColumn("_weight", weight)
    held = F.col("weight").cast(exact) * F.col("_left") > F.col("source_size").cast(exact) * CAP * F.col("_weight")
    level = F.min(F.when(~F.col("_held"), F.struct(F.col("source_size") / F.col("weight"), F.col("_left").cast("double") / F.col("_weight")))).over(every)
    per = per.withColumn("_held", held).withColumn("_level", level["col2"])
    target = F.when(F.col("_held"), (F.col("source_size") * CAP).cast("double")).otherwise(F.col("weight") * F.col("_level"))
    return per.select("source", "source_size", (F.col("source_size") / F.col("docs")).alias("mean"),
                      F.least(target, (F.col("source_size") * CAP).cast("double")).alias("target"))


def rate(lam, size, mean):
    """Exponentially tilted rate under the cap."""
    return F.exp(F.least(lam * size / mean, F.lit(math.log(CAP))))


def balance(counts: DataFrame, goal: DataFrame) -> DataFrame:
    """``goal`` with the multiplier ``lam`` of each source: Newton steps on the
    dual, each one distributed sum; a step that leaves the bracket or meets a
    flat dual is replaced by a halving (or widening) of the bracket."""
    sources = counts.select("source").distinct().count()
    state = stash(goal.select("source", "source_size", "mean", "target", F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("low"),
                              F.lit(None).cast("double").alias("high"),
                              ((F.col("source_size") == 0) | (F.col("target") >= F.col("source_size") * CAP)).alias("done")), "dual", sources)
    exact = "decimal(38,9)"
    for _ in range(MAX_STEPS):
        open_ = state.where(~F.col("done"))
        if open_.isEmpty():
            break
        here = open_.withColumnRenamed("source", "_s").join(counts.where("size > 0"), F.col("source").eqNullSafe(F.col("_s")))
        r = rate(F.col("lam"), F.col("size"), F.col("mean"))
        words = F.col("n") * F.col("size") * r
        slope = F.when(r < CAP, words * F.col("size") / F.col("mean")).otherwise(0.0)
        # a source's state goes with its sums, so that it need not be joined again
        kept = [F.first(c).alias(c) for c in ("source_size", "mean", "target", "lam", "low", "high")]
        step = here.groupBy("source").agg(F.sum(words.cast(exact)).cast("double").alias("words"), F.sum(slope.cast(exact)).cast("double").alias("slope"), *kept)
        off = F.col("words") - F.col("target")
        low = F.when(off < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - off / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.coalesce(F.col("_low"), F.lit(-1e9))) & (newton < F.coalesce(F.col("_high"), F.lit(1e9)))
        wide = F.when(F.col("_high").isNull(), F.col("_low") * 2 + 1).when(F.col("_low").isNull(), F.col("_high") * 2 - 1).otherwise((F.col("_low") + F.col("_high")) / 2)
        step = step.withColumn("_low", low).withColumn("_high", high)
        done = F.abs(off) <= F.col("target") * TOLERANCE
        step = step.select("source", "source_size", "mean", "target", F.when(done, F.col("lam")).when(inside, newton).otherwise(wide).alias("lam"),
                           F.col("_low").alias("low"), F.col("_high").alias("high"), done.alias("done"))
        state = stash(state.where("done").unionByName(step), "dual", sources)
    else:
        raise RuntimeError(f"the mix's dual is not solved after {MAX_STEPS} steps")
    return state


def mix(docs: DataFrame) -> DataFrame:
    """Add source_size, target, copies to ``docs`` (doc_id, source, size and
    whatever else; columns of these three names are replaced)."""
    own = ["source_size", "target", "copies"]
    rows = boxed(docs.drop(*own)).select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), F.col("row.size").cast("long").alias("size"))
    counts = stash(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    dual = balance(counts, targets(counts))
    at = counts.join(dual.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    full = F.col("target") >= F.col("source_size") * CAP
    units = F.when(full, F.lit(CAP * UNIT)).otherwise(F.round(rate(F.col("lam"), F.col("size"), F.greatest(F.col("mean"), F.lit(1e-9))) * UNIT)).cast("long")
    line = W.partitionBy("source").orderBy("size").rowsBetween(W.unboundedPreceding, -1)
    at = at.withColumn("units", units)
    start = F.coalesce(F.sum(F.col("units").cast("decimal(20,0)") * F.col("n")).over(line), F.lit(0))
    at = at.select("source", "size", "source_size", "target", "units", (start % UNIT).cast("long").alias("start"))
    ranked = numbered(rows, ["source", "size"], [F.col("doc_id"), F.xxhash64("row")], "no")
    out = ranked.join(at, same(ranked, at, "source", "size"))
    # where the document's stretch begins, modulo 1, and whole numbers in it
    begin = (F.col("start") + (F.col("no") % UNIT) * (F.col("units") % UNIT)) % UNIT
    return out.select("row.*", "source_size", "target", F.floor((begin + F.col("units")) / UNIT).cast("long").alias("copies"))


def resample(docs: DataFrame) -> DataFrame:
    """``docs`` (any columns, among them doc_id, source, text) with each row as
    often as the mix takes it; rows that repeat a doc_id, source and text are
    taken together.  The rates are found on narrow rows, and the texts are
    shuffled once."""
    doc_id, source, text = F.col("row.doc_id").cast("long"), F.col("row.source").cast("string"), F.col("row.text").cast("string")
    # a hash skips nulls: that a value is one is hashed beside it
    known = [c.isNull() for c in (doc_id, source, text)]
    rows = boxed(docs).select("row", F.xxhash64(doc_id, source, text, *known).alias("h1"), F.xxhash64(*known, text, source, doc_id, F.lit(1)).alias("h2"))
    narrow = rows.select("h1", "h2", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), count_words(text).alias("size"))
    taken = mix(stash(narrow, "sized")).groupBy("h1", "h2").agg(F.sum("copies").alias("copies")).where("copies > 0")
    once = rows.join(taken, ["h1", "h2"]).dropDuplicates(["h1", "h2"])
    return once.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
