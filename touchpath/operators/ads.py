"""Ad-account models: click ids, campaign names, click id -> campaign name."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchpath.config import RunConfig
from touchpath.functions.keys import surrogate_key
from touchpath.sources.ads import union_accounts

CLICK_COLUMNS = ["account", "date", "account_id", "campaign_id", "adgroup_id", "ad_network", "gclid"]


INGESTION_DATE = "ingestion_date"


def ads_click_stats(spark: SparkSession, tables: Mapping[str, str | DataFrame], cfg: RunConfig,
                    with_ingestion: bool = False) -> DataFrame:
    """Model M9: click ids of all accounts, tagged with the account label.

    The window is on the ingestion partition date (a partition column, so it
    prunes folders); full runs read the last 120 days and the same 120 days a
    year earlier, incremental runs the reload days.  ``with_ingestion`` adds
    that date: a stored table is partitioned by it, as a late click of an older
    click date must not replace the clicks that came before it.
    """
    extra = [F.col("_partition_date").alias(INGESTION_DATE)] if with_ingestion else []

    def project(df: DataFrame, account: str) -> DataFrame:
        p = F.col("_partition_date")
        return df.where(cfg.ads_window(p, dev_days=1, incremental=True)).select(
            F.lit(account).alias("account"), F.col("segments_date").alias("date"),
            F.col("customer_id").alias("account_id"), "campaign_id",
            F.col("ad_group_id").alias("adgroup_id"),
            F.col("segments_ad_network_type").alias("ad_network"),
            F.col("click_view_gclid").alias("gclid"), *extra)
    u = union_accounts(spark, tables, project)
    return u.withColumn("sk_id", surrogate_key(F.col("account_id"), F.col("gclid")))


def ads_campaign_names(spark: SparkSession, tables: Mapping[str, str | DataFrame], cfg: RunConfig,
                       ignore_nulls: bool = False) -> DataFrame:
    """Model M10: daily campaign-name snapshots of all accounts.

    ``campaign_name_last_value`` is the last name of the campaign up to the
    row's date inside the same account table.  With the default frame (up to
    the current row's peers) and NULLs respected this is the name of the last
    snapshot row of that same day, so the window only needs the rows of one
    (account, campaign, day); ``ignore_nulls=True`` looks back over earlier
    days for the last non-NULL name instead.
    """
    def project(df: DataFrame, account: str) -> DataFrame:
        p = F.col("_partition_date")
        return df.where(cfg.ads_window(p, dev_days=None, incremental=False)).select(
            F.lit(account).alias("__account"), F.to_date(p).alias("date"),
            "customer_id", "campaign_id", "campaign_name")
    u = union_accounts(spark, tables, project)
    if ignore_nulls:
        w = (Window.partitionBy("__account", "campaign_id").orderBy("date")
             .rangeBetween(Window.unboundedPreceding, Window.currentRow))
        last = F.last("campaign_name", ignorenulls=True).over(w)
    else:
        w = (Window.partitionBy("__account", "campaign_id", "date")
             .orderBy("customer_id", F.col("campaign_name").asc_nulls_first())
             .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        last = F.last("campaign_name").over(w)
    u = u.withColumn("campaign_name_last_value", last)
    return u.select(surrogate_key(F.col("date"), F.col("campaign_id"), F.col("campaign_name")).alias("sk_id"),
                    "date", "customer_id", "campaign_id", "campaign_name", "campaign_name_last_value")


def gclid_campaigns(clicks: DataFrame, names: DataFrame) -> DataFrame:
    """Model M11: clicks LEFT JOIN campaign names USING (date, campaign_id).

    The name side grows with campaigns x days, not with traffic; AQE turns the
    join into a broadcast once the measured shuffle output of that side is
    under the broadcast threshold, and splits a hot (date, campaign) partition
    of the click side otherwise.  A campaign present in several accounts on
    the same day fans its clicks out (as in the original).
    """
    c = clicks.where(F.col("gclid").isNotNull()).select(
        "account", "date", "account_id", "campaign_id", "adgroup_id", "gclid")
    n = names.select("date", "campaign_id", "campaign_name", "campaign_name_last_value")
    j = c.join(n, ["date", "campaign_id"], "left")
    return j.select("account", "date", "account_id", "campaign_id", "adgroup_id", "gclid",
                    F.coalesce("campaign_name", "campaign_name_last_value").alias("campaign_name"))
