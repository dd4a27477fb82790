"""Channel-group rule tables: one positive row per rule, NULL patterns, order conflicts."""

from pyspark.sql import functions as F

from touchpath.functions.channels import CUSTOM_RULES, DEFAULT_RULES, custom_channel_group, default_channel_group

# (source, medium, campaign, pagetype, expected)
CUSTOM_CASES = [
    ("google", "cpc", "x_2_de", "start", "Generic Paid Search Google"),
    ("google", "cpc", "generic_paid_search", None, "Generic Paid Search Google"),
    ("google", "cpc", "x_6_de", None, "Generic Paid Shopping Google"),
    ("google", "cpc", "generic_paid_pmax", None, "Generic Paid Shopping Google"),
    ("bing", "cpc", "x_2_de", None, "Generic Paid Search Bing"),
    ("bing", "cpc", None, None, "Unassigned"),            # NOT rlike(NULL) skips the rule
    ("bing", "cpc", "x_1_de", None, "Brand Paid Search"),
    ("google", "cpc", "brand_paid_search", None, "Brand Paid Search"),
    ("google", "cpc", None, "start", "Unassigned"),
    ("google", "organic", None, "start", "Organic Search Home"),
    ("qwant.com", "referral", None, "start", "Organic Search Home"),
    ("google", "organic", None, None, "Organic Search Non-Home"),
    ("x", "y", "google_shopping_organic", "category", "Organic Search Non-Home"),
    ("google", "organic", None, "magazine", "Organic Search Magazin"),
    ("Newsletter", "email", None, None, "Newsletter"),
    ("crm", "email", "a_kw_ns_b", None, "Newsletter"),
    ("crm", "email", "y24_kw12_de_ns_x", None, "Unassigned"),
    ("parcellab", "email", None, None, "Triggermail Parcellab"),
    ("x", "parcellab", None, None, "Triggermail Parcellab"),
    ("triggermail", "email", None, None, "Triggermail CRM"),
    ("facebook", "cpc", None, None, "Social Paid"),
    ("m.facebook.com", "referral", None, None, "Social Organic"),
    ("IGShopping", "Social", None, None, "Social Organic"),
    ("mydealz", "x", None, None, "PSM"),
    ("x", "y", "a_outdoordeals", None, "PSM"),
    ("awin", "affiliate", None, None, "Affiliate"),
    ("vaude.com", "referral", None, None, "Hersteller Links"),
    ("criteo", "cpm", None, None, "Display"),
    ("bsmart", "x", None, None, "Display"),
    ("google", "cpc", "x_5_de", None, "Display"),                 # order conflict: not paid search
    ("google", "cpc", "display", None, "Display"),
    ("blog", "referral", None, None, "Referral"),
    ("taboola", "native", None, None, "Branding"),
    ("x", "cpm", None, None, "Branding"),
    ("x", "y", "_branding_", None, "Branding"),
    (None, None, None, None, "Direct"),
    (None, None, "only_campaign", "start", "Direct"),
    ("foo", "bar", None, None, "Unassigned"),
    (None, "referral", None, None, "Referral"),
]

# (source, medium, source_category, expected)
DEFAULT_CASES = [
    (None, None, None, "Direct"),
    ("(direct)", "(none)", None, "Direct"),
    ("(direct)", "(not set)", None, "Direct"),
    ("facebook", "cpc", None, "Paid Social"),
    ("reddit", "paid-x", None, "Paid Social"),
    ("instagram", "referral", None, "Organic Social"),
    ("x", "social-media", None, "Organic Social"),
    ("x", "y", "SOURCE_CATEGORY_SOCIAL", "Organic Social"),
    ("newsletter", "e-mail", None, "Email"),
    ("my_email_tool", "x", None, "Email"),
    ("awin", "affiliate", None, "Affiliates"),
    ("shop", "cpc", "SOURCE_CATEGORY_SHOPPING", "Paid Shopping"),
    ("yt", "paid-video", "SOURCE_CATEGORY_VIDEO", "Paid Video"),
    ("dv360_video", "x", None, "Paid Video"),
    ("x", "banner", None, "Display"),
    ("dv360_display", "x", None, "Display"),
    ("google", "ppc", None, "Paid Search"),
    ("x", "cpv", None, "Other Advertising"),
    ("google", "organic", None, "Organic Search"),
    ("x", "y", "SOURCE_CATEGORY_SEARCH", "Organic Search"),
    ("x", "my-video-1", None, "Organic Video"),
    ("x", "y", "SOURCE_CATEGORY_VIDEO", "Organic Video"),
    ("x", "y", "SOURCE_CATEGORY_SHOPPING", "Organic Shopping"),
    ("blog", "referral", None, "Referral"),
    ("x", "audio", None, "Audio"),
    ("x", "sms", None, "Organic Social"),   # '^(..|sm|..)' is a prefix test: the SMS rule never fires
    ("x", "push", None, "Push Notifications"),
    ("firebase", "x", None, "Push Notifications"),
    ("x", "y", None, "(Other)"),
    (None, "y", None, "(Other)"),
]


def test_custom_rules(spark):
    df = spark.createDataFrame(CUSTOM_CASES, "s string, m string, c string, p string, expected string")
    got = df.select("*", custom_channel_group(F.col("s"), F.col("m"), F.col("c"), F.col("p")).alias("g")).collect()
    bad = [(r.s, r.m, r.c, r.p, r.expected, r.g) for r in got if r.g != r.expected]
    assert bad == []
    labels = {r.label for r in CUSTOM_RULES} | {"Unassigned"}
    assert labels == {c[-1] for c in CUSTOM_CASES}


def test_custom_rules_default_pagetype_is_literal_none(spark):
    df = spark.createDataFrame([("google", "organic", None)], "s string, m string, c string")
    g = df.select(custom_channel_group(F.col("s"), F.col("m"), F.col("c")).alias("g")).first().g
    assert g == "Organic Search Non-Home"


def test_default_rules(spark):
    df = spark.createDataFrame(DEFAULT_CASES, "s string, m string, k string, expected string")
    got = df.select("*", default_channel_group(F.col("s"), F.col("m"), F.col("k")).alias("g")).collect()
    bad = [(r.s, r.m, r.k, r.expected, r.g) for r in got if r.g != r.expected]
    assert bad == []
    assert {r.label for r in DEFAULT_RULES} | {"(Other)"} == {c[-1] for c in DEFAULT_CASES} | {"SMS"}
