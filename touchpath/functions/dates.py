"""Date helpers: shard dates, look-back windows and partition lists.

Bounds are computed in Python from ``run_date`` and passed as literals, which
keeps the predicates constant-folded and lets Parquet partition pruning use
them.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

SHARD_PATTERN = r"events_(?:intraday_)?([0-9]{8})"


def minus_years(d: date, years: int = 1) -> date:
    """Calendar year subtraction; 29 February maps to 28 February."""
    try:
        return d.replace(year=d.year - years)
    except ValueError:
        return d.replace(year=d.year - years, day=28)


def parse_yyyymmdd(c: Column, safe: bool = False) -> Column:
    """``parse_date('%Y%m%d', s)``; ``safe`` returns NULL instead of raising."""
    return F.try_to_date(c, "yyyyMMdd") if safe else F.to_date(c, "yyyyMMdd")


def first_number(c: Column) -> Column:
    """``regexp_extract(s, '[0-9]+')`` with NULL (not '') when nothing matches."""
    return F.nullif(F.regexp_extract(c, "[0-9]+", 0), F.lit(""))


def shard_date(path: Column) -> Column:
    """Date of a ``events_YYYYMMDD`` / ``events_intraday_YYYYMMDD`` shard path."""
    return F.to_date(F.nullif(F.regexp_extract(path, SHARD_PATTERN, 1), F.lit("")), "yyyyMMdd")


def last_n_days_bounds(run_date: date, n: int) -> tuple[date, date]:
    return run_date - timedelta(days=n), run_date - timedelta(days=1)


def prev_year_bounds(run_date: date, n: int) -> tuple[date, date]:
    """Same window one year earlier; ends on the same day, not the day before."""
    py = minus_years(run_date, 1)
    return py - timedelta(days=n), py


def last_n_days(c: Column, run_date: date, n: int) -> Column:
    lo, hi = last_n_days_bounds(run_date, n)
    return c.between(F.lit(lo), F.lit(hi))


def last_n_days_prev_year(c: Column, run_date: date, n: int) -> Column:
    lo, hi = prev_year_bounds(run_date, n)
    return c.between(F.lit(lo), F.lit(hi))


def two_windows(c: Column, run_date: date, n: int) -> Column:
    return last_n_days(c, run_date, n) | last_n_days_prev_year(c, run_date, n)


def in_dates(c: Column, days: list[date]) -> Column:
    return c.isin([F.lit(d) for d in days])


def incremental_range(c: Column, hwm: date, run_date: date) -> Column:
    return c.between(F.lit(hwm), F.lit(run_date - timedelta(days=1)))
