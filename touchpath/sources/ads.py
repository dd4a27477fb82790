"""Ad-account tables: click stats and daily campaign snapshots, one table per account."""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

PERFORMANCE_COUNTRIES = ("de", "at")
BRAND_COUNTRIES = ("de", "at", "ch")


def account_labels(performance=PERFORMANCE_COUNTRIES, brand=BRAND_COUNTRIES) -> list[str]:
    """Performance accounts are named by country, brand accounts '<country>_brand'."""
    return list(performance) + [f"{c}_brand" for c in brand]


def resolve(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """A registry entry is a path (read as Parquet) or a DataFrame."""
    return spark.read.parquet(table) if isinstance(table, str) else table


def union_accounts(spark: SparkSession, tables: Mapping[str, str | DataFrame], project) -> DataFrame:
    """``project(df, account)`` per account table, then one n-ary UNION ALL."""
    parts = [project(resolve(spark, t), acc) for acc, t in tables.items()]
    if not parts:
        raise ValueError("no account tables configured")
    return reduce(lambda a, b: a.unionByName(b), parts)


class SourceRegistry:
    """Logical source name -> table location (path or DataFrame).

    A table's name is ``<kind>_<account>``.  The models read ``click_stats``,
    ``campaigns`` and ``shopping_products``; the other declared kinds can be named
    and read all the same (:meth:`table`, :meth:`create_views`).
    """

    CLICKS, CAMPAIGNS, SHOPPING = "click_stats_", "campaigns_", "shopping_products_"
    #: Kinds that every account has, those of performance accounts, and of the
    #: brand accounts with regional statistics.
    EVERY = ("click_stats", "campaigns")
    PERFORMANCE = ("search_query_stats", "campaign_stats", "ad_stats", "ads", "ad_groups", "ad_group_stats", "criteria", "keywords")
    REGIONAL = ("geo_stats",)

    def __init__(self, entries: Mapping[str, str | DataFrame] | None = None):
        self.entries = dict(entries or {})

    @classmethod
    def declared(cls, root: str, accounts: list[str] | None = None, shopping: list[str] | None = None,
                 regional: tuple[str, ...] = ("de_brand",)) -> "SourceRegistry":
        """The declared tables below one folder: click stats and campaigns of
        every account, statistics and entities of the performance accounts, regional
        ones of the accounts ``regional``, and shopping products of those that have
        them."""
        root = root.rstrip("/")
        accounts = accounts or account_labels()
        names = [f"{kind}_{a}" for a in accounts for kind in cls.EVERY]
        names += [f"{kind}_{a}" for a in accounts if not a.endswith("_brand") for kind in cls.PERFORMANCE]
        names += [f"{kind}_{a}" for a in accounts if a in regional for kind in cls.REGIONAL]
        names += [f"{cls.SHOPPING}{a}" for a in shopping or ()]
        return cls({n: f"{root}/{n}" for n in names})

    def register(self, name: str, table: str | DataFrame) -> "SourceRegistry":
        self.entries[name] = table
        return self

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self.entries:
            raise KeyError(f"no source {name!r}; declared: {', '.join(sorted(self.entries))}")
        return resolve(spark, self.entries[name])

    def accounts(self, prefix: str) -> dict[str, str | DataFrame]:
        """Entries named '<prefix><account>' keyed by account label."""
        return {k[len(prefix):]: v for k, v in self.entries.items() if k.startswith(prefix)}

    @property
    def clicks(self) -> dict[str, str | DataFrame]:
        return self.accounts(self.CLICKS)

    @property
    def campaigns(self) -> dict[str, str | DataFrame]:
        return self.accounts(self.CAMPAIGNS)

    @property
    def shopping(self) -> dict[str, str | DataFrame]:
        return self.accounts(self.SHOPPING)

    def present(self, spark: SparkSession) -> dict[str, bool]:
        """Whether each table is there (a DataFrame always is)."""
        from touchpath.sources.sinks import exists

        return {n: not isinstance(t, str) or exists(spark, t) for n, t in self.entries.items()}

    def create_views(self, spark: SparkSession, only_present: bool = False) -> list[str]:
        """A temporary view of each table, by its name."""
        there = self.present(spark) if only_present else dict.fromkeys(self.entries, True)
        names = [n for n in self.entries if there[n]]
        for name in names:
            self.table(spark, name).createOrReplaceTempView(name)
        return names
