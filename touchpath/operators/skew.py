"""Skew-proof building blocks.

Any single key (a NULL key, a bot user, one campaign) may hold a large share
of all rows.  These helpers keep such a key from landing in one task:

* ``number_within`` computes ``row_number() over (partition by key order by
  ts)`` on (key, time bucket) sub-groups and adds the row counts of earlier
  buckets, which come from a small per-(key, bucket) count table.
* ``left_join_nonnull`` spreads rows whose join key is NULL (they can never
  match) over all partitions instead of hashing them all to one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchpath.operators.membership import key_filter, with_membership
from touchpath.session import shuffle_width

_K, _KN, _B = "__k", "__k_null", "__b"
#: Slices of a bucket that holds a hot key's rows, and the rows from which on a
#: (key, bucket) group is hot; the NULL key always is.
FINE_SLICES = 600
HOT_ROWS = 1_000_000


def _key_cols(key: str) -> list[Column]:
    # NULL keys are one group (as in a window); a non-null surrogate plus a
    # null flag keeps them hashable without colliding with a real ''.
    return [F.coalesce(F.col(key).cast("string"), F.lit("")).alias(_K), F.col(key).isNull().alias(_KN)]


def number_within(df: DataFrame, key: str, order: list[str], width: int, out: str,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Exact ``row_number() over (partition by key order by order...)``.

    Time buckets are ``width`` units of the first ``order`` column; every row of
    an earlier bucket comes first.  Window partitions are (key, bucket), so a
    hot key is spread over its buckets.  Where a single bucket is hot (the NULL
    key, or measured to hold over ``hot_rows`` rows), it is cut into slices of its
    time.  The per-key prefix sum runs on counts, whose number per key is bounded by
    its buckets and slices, not by its rows.

    ``df`` is read twice: the key and the time for the counts, then the rows.  Where
    a bucket is hot, those columns are read once more for the counts of its slices;
    where none is, the adaptive plan drops that branch unread.
    """
    # a NULL bucket (NULL order value) sorts first: give it the lowest bucket.
    # All three sub-keys are non-null, so the final join is a plain equi-join
    # whose keys equal the window's hash partitioning: the event side is not
    # shuffled a second time.
    lowest = F.lit(-(2 ** 63))
    ts = F.col(order[0])
    coarse = F.coalesce(F.floor(ts / F.lit(width)).cast("long"), lowest)
    slice_ = F.coalesce(F.floor((ts - F.floor(ts / F.lit(width)) * width) * FINE_SLICES / F.lit(width)).cast("long"), F.lit(0))
    tmp = df.select("*", *_key_cols(key)).withColumns({"__c": coarse, "__s": slice_})
    fine = lambda slice_: F.when(F.col("__c") == lowest, lowest).otherwise(F.col("__c") * FINE_SLICES + slice_)
    parts = [_K, _KN, _B]
    number = F.count(F.lit(1)).alias("__n")
    counts = tmp.groupBy(_K, _KN, "__c", F.when(F.col(_KN), F.col("__s")).otherwise(F.lit(0).cast("long")).alias("__s")).agg(number)
    # hot buckets number under rows / hot_rows
    hot = F.broadcast(counts.where(~F.col(_KN) & (F.col("__n") > hot_rows)).select(_K, "__c", F.lit(False).alias(_KN), F.lit(True).alias("__hot")))
    whole = counts.join(hot, [_K, _KN, "__c"], "left").where(F.col("__hot").isNull()).drop("__hot")
    sliced = tmp.select(_K, _KN, "__c", "__s").join(hot, [_K, _KN, "__c"]).groupBy(_K, _KN, "__c", "__s").agg(number)
    sizes = whole.unionByName(sliced).select(_K, _KN, fine(F.col("__s")).alias(_B), "__n")
    offsets = sizes.select(*parts, F.coalesce(
        F.sum("__n").over(Window.partitionBy(_K, _KN).orderBy(_B)
                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    tmp = tmp.join(hot, [_K, _KN, "__c"], "left")
    tmp = tmp.withColumn(_B, fine(F.when(F.col(_KN) | F.col("__hot"), F.col("__s")).otherwise(0))).drop("__c", "__s", "__hot")
    local = tmp.withColumn("__local", F.row_number().over(
        Window.partitionBy(*parts).orderBy(*[F.col(c).asc_nulls_first() for c in order])))
    joined = local.join(offsets, parts, "inner")
    return joined.select(*df.columns, (F.col("__local") + F.col("__off")).cast("long").alias(out))


def left_join_nonnull(left: DataFrame, right: DataFrame, on: list[str],
                      right_cols: list[str]) -> DataFrame:
    """``left LEFT JOIN right USING (on)``, with one read of ``left``.

    Rows with a NULL key match nothing; a salt in the join key spreads them over
    all partitions (it is 0 wherever a key could match).  Output columns follow
    USING: keys, other left columns, then ``right_cols``.
    """
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    other = [c for c in left.columns if c not in on]
    plain = [c for c, t in left.dtypes if not t.startswith(("array", "map", "struct")) and c not in on]
    n = shuffle_width(left.sparkSession)
    salt = F.when(has_null, F.pmod(F.xxhash64(*plain), F.lit(n))).otherwise(F.lit(0))
    # always 0, but not a constant to the optimizer: a constant would leave the
    # key alone to hash on
    zero = F.pmod(F.xxhash64(*on), F.lit(1))
    a = left.withColumn("__salt", salt)
    b = right.select(*on, *right_cols).withColumn("__salt", zero.cast("long"))
    return a.withColumn("__salt", F.col("__salt").cast("long")).join(b, [*on, "__salt"], "left").select(*on, *other, *right_cols)


def left_join_known(left: DataFrame, right: DataFrame, on: list[str], right_cols: list[str]) -> DataFrame:
    """``left LEFT JOIN right USING (on)`` where few rows of ``left`` have a partner.

    A bounded filter of ``right``'s keys is broadcast; rows that it excludes (and
    those with a NULL key) get NULLs where they are read and are not shuffled.
    ``left`` is read twice, so it should be a stored table; :func:`left_join_nonnull`
    reads it once and shuffles all of it.
    """
    other = [c for c in left.columns if c not in on]
    names = right.select(*on, *right_cols)
    marked = with_membership(left, on, key_filter(names, on), "__may")
    hit = marked.where("__may").join(names, on, "left").select(*on, *other, *right_cols)
    nulls = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols]
    return hit.unionByName(marked.where("NOT __may").select(*on, *other, *nulls))
