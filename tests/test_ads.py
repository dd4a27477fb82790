"""Campaign-name snapshots: same-day peers, NULL names, the ignore-NULLs option,
and the click -> name join with a campaign in two accounts."""

from datetime import date

from touchpath.config import RunConfig
from touchpath.operators.ads import ads_campaign_names, ads_click_stats, gclid_campaigns

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
CAMP = "customer_id bigint, campaign_id bigint, campaign_name string, _partition_date date"
CLICK = ("segments_date date, customer_id bigint, campaign_id bigint, ad_group_id bigint, "
         "segments_ad_network_type string, click_view_gclid string, _partition_date date")


def test_campaign_names(spark):
    de = spark.createDataFrame([(1, 7, "a", D1), (1, 7, None, D2), (1, 7, "b", D3), (2, 7, "c", D3)], CAMP)
    at = spark.createDataFrame([(5, 7, "z", D2)], CAMP)
    cfg = RunConfig(run_date=date(2024, 1, 10))
    got = {(r.date, r.customer_id): (r.campaign_name, r.campaign_name_last_value)
           for r in ads_campaign_names(spark, {"de": de, "at": at}, cfg).collect()}
    # default frame: the last row of the same day in the same account (peers ordered by customer, name)
    assert got[(D1, 1)] == ("a", "a")
    assert got[(D2, 1)] == (None, None)              # a NULL name stays NULL
    assert got[(D3, 1)] == ("b", "c") and got[(D3, 2)] == ("c", "c")
    assert got[(D2, 5)] == ("z", "z")                # per account table
    nn = {(r.date, r.customer_id): r.campaign_name_last_value
          for r in ads_campaign_names(spark, {"de": de, "at": at}, cfg, ignore_nulls=True).collect()}
    assert nn[(D2, 1)] == "a"                        # last non-NULL name up to that day


def test_gclid_campaigns_fan_out_and_window(spark):
    cfg = RunConfig(run_date=date(2024, 1, 10))
    clicks = spark.createDataFrame([(D1, 1, 3, 10, "SEARCH", "g1", D1), (D1, 1, 4, 11, "SEARCH", None, D1),
                                    (D2, 1, 3, 10, "SEARCH", "g2", date(2023, 6, 1))], CLICK)
    c = ads_click_stats(spark, {"de": clicks}, cfg)
    assert c.count() == 2                            # ingestion date outside both windows is dropped
    names = ads_campaign_names(spark, {"de": spark.createDataFrame([(1, 3, "x_4_de", D1)], CAMP),
                                       "at": spark.createDataFrame([(5, 3, "x_9_de", D1)], CAMP)}, cfg)
    got = sorted((r.gclid, r.campaign_name) for r in gclid_campaigns(c, names).collect())
    assert got == [("g1", "x_4_de"), ("g1", "x_9_de")]   # NULL gclid dropped; two accounts fan out
