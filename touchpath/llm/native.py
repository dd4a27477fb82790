"""Regular-expression matches with positions, and text rewriting, as DataFrame
expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches per block of the prefix sums.
_BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def before(lengths: Column) -> Column:
    """Exclusive prefix sums of an array of numbers, by blocks: linear in the
    array's length but for a block's factor."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)

    def build(n: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(n) - 1) / _BLOCK).cast("int"))
        sums = F.transform(blocks, lambda b: total(F.slice(n, b * _BLOCK + 1, F.lit(_BLOCK))))

        def within(s: Column) -> Column:
            base = F.aggregate(s, F.array(F.lit(0).cast("long")), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))
            return let(base, lambda at: F.transform(n, lambda _, i: at[F.floor(i / _BLOCK).cast("int")] + total(F.slice(n, i - i % _BLOCK + 1, i % _BLOCK))))

        return let(sums, within)

    none = F.array().cast("array<bigint>")
    return F.when(F.size(lengths) == 0, none).otherwise(build(lengths))


def matches(text: Column, regex: str, group: int = 0) -> Column:
    """array<struct<start, end, value>>: the leftmost non-overlapping matches
    of ``regex`` in code points, end exclusive.  With a ``group``, its span; the
    group has to stand at the end of the match."""
    pair = F.struct(F.split(text, regex, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("whole"),
                    F.regexp_extract_all(text, F.lit(regex), F.lit(group)).alias("value"))

    def spans(p: Column) -> Column:
        # what lies up to the end of each match: the gap before it and itself
        steps = F.zip_with(F.slice(p["gaps"], F.lit(1), F.size(p["whole"])), p["whole"], lambda g, m: F.length(g).cast("long") + F.length(m))
        ends = let(steps, lambda s: F.zip_with(before(s), s, lambda a, b: a + b))
        return F.zip_with(ends, p["value"], lambda e, v: F.struct((e - F.length(v)).alias("start"), e.alias("end"), v.alias("value")))

    return let(pair, spans)


def rewrite(text: Column, regex: str, change: Callable[[Column], Column]) -> Column:
    """``text`` with each match of ``regex`` put through ``change``."""
    pair = F.struct(F.split(text, regex, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("whole"))

    def joined(p: Column) -> Column:
        heads = F.zip_with(F.slice(p["gaps"], F.lit(1), F.size(p["whole"])), F.transform(p["whole"], change), lambda g, m: F.concat(g, m))
        return F.concat(F.array_join(heads, ""), F.element_at(p["gaps"], -1))

    return let(pair, joined)
