"""Campaign names advanced by new snapshots only.

The original rebuilds this model over both 120-day windows on every run.  Here the
stored table (``ads_campaign_names``, partitioned by snapshot day) is brought up to
the run date instead; a run reads the snapshot days that it writes, and no others.

* By default a row's last name is that of its own day (NULL names respected), so a
  day is finished by its own snapshots: a run loads the reload days and whatever days
  have come into the two windows, and drops those that have left them.
* With ``carry``, a row shows the last name that was not NULL, up to its day and since
  the first day of the first load.  What a run needs of the past is one name per
  campaign and account: the state, kept as of the day before the next run's first.
  Days stay when they leave the windows, as later rows may owe their names to them.

A day is reduced to one name per campaign and account before names are carried over
days, so the window that carries them holds one row per day, however many customers
share a campaign.

The state is replaced after the rows that it belongs to: a run that fails in between
is repeated by the next one, which then starts at the earlier state.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchpath.config import RunConfig
from touchpath.functions import dates as D
from touchpath.functions.keys import surrogate_key
from touchpath.operators import ads as A
from touchpath.sources import sinks
from touchpath.sources.ads import resolve, union_accounts

#: Partition column of the states: names up to and including that day.
AS_OF = "as_of"
STEP = ["account", "campaign_id", "date"]
ONE_DAY = timedelta(days=1)


def days_between(first: date, last: date) -> list[date]:
    return [date.fromordinal(o) for o in range(first.toordinal(), last.toordinal() + 1)]


def window_days(run_date: date, n: int = 120) -> list[date]:
    """Days of the two windows that the model covers."""
    return sorted({*days_between(*D.last_n_days_bounds(run_date, n)), *days_between(*D.prev_year_bounds(run_date, n))})


class CampaignNames:
    """The tables below ``root`` and how a run advances them."""

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, str | DataFrame], carry: bool = False) -> None:
        self.spark, self.tables, self.carry = spark, tables, carry
        self.names = f"{root.rstrip('/')}/ads_campaign_names"
        self.states = f"{root.rstrip('/')}/campaign_name_states"
        #: snapshot days that the last run read
        self.loaded: list[date] = []
        # of the table, once this object has written it: a table without rows tells none
        self._schema: StructType | None = None

    def table(self) -> DataFrame:
        reader = self.spark.read if self._schema is None else self.spark.read.schema(self._schema)
        return reader.parquet(self.names)

    def advance(self, run_date: date, reload_days: int = 2) -> StructType:
        """Bring the table up to ``run_date``, all of it if none is stored; returns
        its schema."""
        mark = sinks.high_water_mark(self.spark, self.names, "date")
        if mark is not None and mark >= run_date:
            raise ValueError(f"campaign names are loaded up to {mark}: a run for {run_date} would go back in time")
        # the mark's own day is reloaded too: it may have been partial
        again = None if mark is None else min(mark, run_date - timedelta(days=reload_days))
        self._schema = (self._advance_carried if self.carry else self._advance_windows)(run_date, again, reload_days)
        return self._schema

    def _stored(self, path: str, col: str) -> set[date]:
        return {d for d in sinks.partition_days(self.spark, path, col) if d is not None}

    def _snapshots(self, days: Column) -> dict[str, DataFrame]:
        """The account tables' rows of some days (literals, so they prune)."""
        return {a: resolve(self.spark, t).where(days) for a, t in self.tables.items()}

    def _write(self, rows: DataFrame, full: bool) -> StructType:
        if full:
            sinks.write_full(rows, self.names, partition_by="date")
        else:
            sinks.write_static(self.spark, rows, self.names, "date", self.loaded, guard_schema=True)
        return rows.schema

    # ------------------------------------------------------------ names of the day
    def _advance_windows(self, run_date: date, again: date | None, reload_days: int) -> StructType:
        wanted = window_days(run_date)
        stored = set() if again is None else self._stored(self.names, "date")
        self.loaded = [d for d in wanted if again is None or d >= again or d not in stored]
        snapshots = self._snapshots(D.in_dates(F.col("_partition_date"), self.loaded))
        schema = self._write(A.ads_campaign_names(self.spark, snapshots, RunConfig(run_date=run_date)), full=again is None)
        for d in stored.difference(wanted):
            sinks.remove(self.spark, f"{self.names}/{sinks.partition_name('date', d)}")
        return schema

    # -------------------------------------------------------------- carried names
    def _advance_carried(self, run_date: date, again: date | None, reload_days: int) -> StructType:
        if again is None:
            sinks.remove(self.spark, self.states)
            before, first = [], D.prev_year_bounds(run_date, 120)[0]
        else:
            before = sorted(d for d in self._stored(self.states, AS_OF) if d < again)
            # without a state that is early enough, all that is stored is loaded anew
            first = before[-1] + ONE_DAY if before else min(self._stored(self.names, "date"))
        last = run_date - ONE_DAY
        self.loaded = days_between(first, last)

        tables = self._snapshots(F.col("_partition_date").between(F.lit(first), F.lit(last)))
        rows = union_accounts(self.spark, tables, lambda df, account: df.select(
            F.lit(account).alias("account"), F.to_date("_partition_date").alias("date"), "customer_id", "campaign_id", "campaign_name"))
        known = F.max(F.when(F.col("campaign_name").isNotNull(), F.struct("customer_id", "campaign_name")))
        steps = rows.groupBy(*STEP).agg(known["campaign_name"].alias("name"))
        if before:
            state = self.spark.read.parquet(self.states).where(F.col(AS_OF) == F.lit(before[-1]))
            steps = steps.unionByName(state.select("account", "campaign_id", F.col(AS_OF).alias("date"), "name"))
        upto = Window.partitionBy("account", "campaign_id").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        steps = steps.withColumn("name", F.last("name", ignorenulls=True).over(upto))

        with sinks.staging(self.spark, self.states, "steps") as tmp:
            steps.write.parquet(tmp)  # read for the rows and for the next state
            steps = self.spark.read.schema(steps.schema).parquet(tmp)
            on = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(steps[c]) for c in STEP])
            schema = self._write(rows.join(steps, on).select(
                surrogate_key(rows["date"], rows["campaign_id"], F.col("campaign_name")).alias("sk_id"), rows["date"],
                "customer_id", rows["campaign_id"], "campaign_name", F.col("name").alias("campaign_name_last_value")), full=again is None)
            self._keep(steps, run_date, first, reload_days)
        return schema

    def _keep(self, steps: DataFrame, run_date: date, first: date, reload_days: int) -> None:
        """Keep the state as of the day before those that a run of the day after
        would load anew."""
        mark = sinks.high_water_mark(self.spark, self.names, "date")
        if mark is None:
            return
        day = max(first, min(mark, run_date + ONE_DAY - timedelta(days=reload_days))) - ONE_DAY
        stored = self._stored(self.states, AS_OF)
        if day not in stored:
            state = (steps.where(F.col("date") <= F.lit(day)).groupBy("account", "campaign_id")
                          .agg(F.max_by("name", "date").alias("name")).withColumn(AS_OF, F.lit(day)))
            state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(AS_OF).parquet(self.states)
        for d in stored - {day}:
            sinks.remove(self.spark, f"{self.states}/{sinks.partition_name(AS_OF, d)}")
