"""Data-quality checks.  Each check is one distributed aggregate returning
``(check, n_failed, status)``; thresholds decide pass / warn / fail."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status(n_failed: Column, severity: str = "error", warn_if: int = 0, error_if: int = 0) -> Column:
    """``fail`` when severity is error and n > error_if; ``warn`` when n > warn_if."""
    warn = F.when(n_failed > F.lit(warn_if), F.lit("warn")).otherwise(F.lit("pass"))
    if severity == "error":
        return F.when(n_failed > F.lit(error_if), F.lit("fail")).otherwise(warn)
    if severity == "warn":
        return warn
    raise ValueError(severity)


def _result(df: DataFrame, name: str, n: Column, severity: str, warn_if: int, error_if: int) -> DataFrame:
    return (df.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("n_failed"))
              .select(F.lit(name).alias("check"), "n_failed",
                      status(F.col("n_failed"), severity, warn_if, error_if).alias("status")))


def day_coverage(df: DataFrame, date_col: str, start: date, end: date, name: str = "day_coverage",
                 severity: str = "warn", warn_if: int = 0, error_if: int = 0) -> DataFrame:
    """Days in [start, end) without a row.  The spine has one row per day of
    the configured range; the table side is reduced to its distinct days
    (partial aggregation) before the anti join."""
    spine = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end - timedelta(days=1)))).alias("d"))
    have = (df.where(F.col(date_col).between(F.lit(start), F.lit(end - timedelta(days=1))))
              .select(F.col(date_col).alias("d")).distinct())
    missing = spine.join(have, "d", "left_anti")
    return _result(missing, name, F.count(F.lit(1)), severity, warn_if, error_if)


def not_null(df: DataFrame, col: str, name: str | None = None, severity: str = "error",
             warn_if: int = 0, error_if: int = 0) -> DataFrame:
    return _result(df, name or f"not_null:{col}", F.count_if(F.col(col).isNull()), severity, warn_if, error_if)


def unique(df: DataFrame, col: str, row_condition: Column | None = None, name: str | None = None,
           severity: str = "error", warn_if: int = 0, error_if: int = 0) -> DataFrame:
    """Number of non-NULL values occurring more than once (under a row condition)."""
    d = df if row_condition is None else df.where(row_condition)
    dup = (d.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1))
    return _result(dup, name or f"unique:{col}", F.count(F.lit(1)), severity, warn_if, error_if)


def in_set(df: DataFrame, col: str, values: list[str], row_condition: Column | None = None,
           name: str | None = None, severity: str = "error", warn_if: int = 0, error_if: int = 0) -> DataFrame:
    d = df if row_condition is None else df.where(row_condition)
    return _result(d, name or f"in_set:{col}", F.count_if(~F.col(col).isin(values)), severity, warn_if, error_if)


def unique_proportion(df: DataFrame, col: str, min_value: float, max_value: float,
                      name: str | None = None, severity: str = "error") -> DataFrame:
    """1 failure when count(distinct col) / count(col) is outside [min, max].
    Exact distinct count: an approximate one would break a 1..1 bound."""
    ratio = F.count_distinct(F.col(col)) / F.count(F.col(col))
    bad = F.when(ratio.isNull() | (ratio < F.lit(min_value)) | (ratio > F.lit(max_value)), F.lit(1)).otherwise(F.lit(0))
    return _result(df, name or f"unique_proportion:{col}", bad, severity, 0, 0)


#: Every day since has rows in the shopping-product sources (fixed value).
SHOPPING_SINCE = date(2022, 7, 1)
GADS_CAMPAIGN_TYPES = ["generic_paid_shopping", "generic_paid_search", "brand_paid_search"]


def _days_seen(date_col: str, start: date, end: date, when: Column | None = None) -> Column:
    """Aggregate: a bit for each day in [start, end) that has rows (a range of
    up to 63 days)."""
    day = F.datediff(F.col(date_col), F.lit(start))
    inside = day.between(0, (end - start).days - 1)
    return F.coalesce(F.bit_or(F.when(inside if when is None else inside & when, F.call_function("shiftleft", F.lit(1).cast("bigint"), day))),
                      F.lit(0).cast("bigint"))


def _missing(seen: Column, start: date, end: date) -> Column:
    return F.lit((end - start).days) - F.bit_count(seen)


def result_rows(df: DataFrame, checks: list[tuple]) -> DataFrame:
    """One result row per (name, failed, severity, warn_if) of a one-row table."""
    out = [F.struct(F.lit(name).alias("check"), n.cast("bigint").alias("n_failed"), status(n, severity, warn_if).alias("status"))
           for name, n, severity, warn_if in checks]
    return df.select(F.explode(F.array(*out)).alias("r")).select("r.*")


def model_suite(silent: DataFrame, pageviews: DataFrame, channel_groups: DataFrame,
                session_starts: DataFrame, run_date: date) -> DataFrame:
    """The data tests configured on the models, as one DataFrame of results.

    * silent sessions: every day of the last 30 has rows (warn)
    * repaired page views: every day of the last 44 has rows (warn); the ad
      campaign type parameter is one of three values over the last 7 days
      (warn above 5); session and user key not NULL (error)
    * channel groups: one row per session key (warn)
    * session starts: every day of the last 10 has rows (warn); the event key
      is not NULL (error) and unique over the last 10 days (warn above 1000)
    Day-coverage ranges end before ``run_date`` (the range end is exclusive).

    Each input is read once: all its checks come out of one aggregate (days seen
    are bits of a number).
    """
    days = lambda n: run_date - timedelta(days=n)
    d = F.col("event_date_dt")
    kind = F.col("session_gadscampaign")
    last7 = d.between(F.lit(days(7)), F.lit(days(1))) & kind.isNotNull()
    last10 = d.between(F.lit(days(10)), F.lit(days(1)))
    seen = F.col("seen")

    a = silent.agg(_days_seen("event_date_dt", days(30), run_date).alias("seen"))
    b = pageviews.agg(
        _days_seen("event_date_dt", days(44), run_date).alias("seen"),
        F.count_if(last7 & ~kind.isin(GADS_CAMPAIGN_TYPES)).alias("odd"),
        F.count_if(F.col("session_key").isNull()).alias("no_session"), F.count_if(F.col("user_key").isNull()).alias("no_user"))
    # rows per key, then their number: exact, and combined map-side for a hot key
    c = (channel_groups.where(F.col("session_key").isNotNull()).groupBy("session_key").agg(F.count(F.lit(1)).alias("n"))
         .agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")))
    e = (session_starts.groupBy("sk_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(last10).alias("n10"),
                                             _days_seen("event_date_dt", days(10), run_date).alias("seen"))
         .agg(F.coalesce(F.bit_or("seen"), F.lit(0).cast("bigint")).alias("seen"),
              F.coalesce(F.sum(F.when(F.col("sk_id").isNull(), F.col("n"))), F.lit(0)).alias("no_key"),
              F.count_if(F.col("sk_id").isNotNull() & (F.col("n10") > 1)).alias("repeated")))
    out = result_rows(a, [("silent_sessions:day_coverage", _missing(seen, days(30), run_date), "warn", 0)])
    out = out.unionByName(result_rows(b, [
        ("pageviews:day_coverage", _missing(seen, days(44), run_date), "warn", 0),
        ("pageviews:session_gadscampaign_in_set", F.col("odd"), "warn", 5),
        ("pageviews:session_key_not_null", F.col("no_session"), "error", 0),
        ("pageviews:user_key_not_null", F.col("no_user"), "error", 0)]))
    one_each = F.when((F.col("rows") > 0) & (F.col("keys") == F.col("rows")), F.lit(0)).otherwise(F.lit(1))
    out = out.unionByName(result_rows(c, [("channel_groups:session_key_unique_proportion", one_each, "warn", 0)]))
    return out.unionByName(result_rows(e, [
        ("session_starts:day_coverage", _missing(seen, days(10), run_date), "warn", 0),
        ("session_starts:sk_id_not_null", F.col("no_key"), "error", 0),
        ("session_starts:sk_id_unique", F.col("repeated"), "warn", 1000)]))


def uniqueness_suite(channel_groups: DataFrame, session_starts: DataFrame, run_date: date) -> DataFrame:
    """The tests of :func:`model_suite` that need the rows themselves: one channel
    group per session key, and event keys that are unique over the last 10 days
    (only those days are read)."""
    c = (channel_groups.where(F.col("session_key").isNotNull()).groupBy("session_key").agg(F.count(F.lit(1)).alias("n"))
         .agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")))
    one_each = F.when((F.col("rows") > 0) & (F.col("keys") == F.col("rows")), F.lit(0)).otherwise(F.lit(1))
    last10 = F.col("event_date_dt").between(F.lit(run_date - timedelta(days=10)), F.lit(run_date - timedelta(days=1)))
    return result_rows(c, [("channel_groups:session_key_unique_proportion", one_each, "warn", 0)]).unionByName(
        unique(session_starts, "sk_id", last10, "session_starts:sk_id_unique", "warn", 1000))


def source_day_coverage(tables: dict[str, DataFrame], date_col: str, start: date, end: date,
                        prefix: str = "source") -> DataFrame:
    """Day coverage of each account source table (one result row per table)."""
    out = None
    for name, df in tables.items():
        r = day_coverage(df, date_col, start, end, f"{prefix}_{name}:day_coverage")
        out = r if out is None else out.unionByName(r)
    return out
