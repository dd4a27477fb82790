"""A bounded membership filter: which rows may have a partner, before they are shuffled.

The keys of the smaller side set bits of one bitmap, by their hash; a row of the
larger side whose bit is not set has no partner.  The bitmap is a DataFrame of
64-bit words, built by a grouped OR, so it has at most ``BITS / 64`` rows whatever
the number of keys: that is the bound on which it is broadcast.  With many more keys
than bits it lets all rows pass, and only the saving is gone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter (a power of two): 2^20 words at most.
BITS = 1 << 26

_WORD, _SET = "__word", "__set"


def _place(keys: list[Column]) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit(BITS - 1))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


def key_filter(members: DataFrame, keys: list[str]) -> DataFrame:
    """The words of the bitmap of ``members``' keys; a key with a NULL is no member."""
    known = members.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    place = _place([F.col(k) for k in keys])
    return known.groupBy(F.shiftright(place, 6).alias(_WORD)).agg(F.bit_or(_bit(place)).alias(_SET))


def with_membership(rows: DataFrame, keys: list[str], words: DataFrame, out: str) -> DataFrame:
    """``rows`` with ``out``: False where the row's key is certainly no member."""
    place = _place([F.col(k) for k in keys])
    some = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    marked = rows.withColumn("__own", F.when(some, F.shiftright(place, 6)))
    both = marked.join(F.broadcast(words), F.col("__own") == F.col(_WORD), "left")
    found = F.coalesce(F.col(_SET).bitwiseAND(_bit(place)) != 0, F.lit(False))
    return both.select(*[rows[c] for c in rows.columns], found.alias(out))


def possible_members(rows: DataFrame, keys: list[str], words: DataFrame) -> DataFrame:
    """The rows whose key may be a member."""
    return with_membership(rows, keys, words, "__may").where("__may").drop("__may")
