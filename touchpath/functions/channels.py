"""Rule-based channel groups: rules are data, folded into one CASE chain.

A rule set is an ordered list of ``Rule(label, predicate)``; the first rule
whose predicate is TRUE wins (SQL three-valued logic: a NULL predicate does
not match, so ``NOT rlike(NULL)`` skips the rule).  The chain is a single
``CASE WHEN`` expression evaluated inside whole-stage codegen; literal regex
patterns are compiled once per task.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Labels and patterns must equal the original rule sets so the
# same traffic lands in the same channel.  Stated in rule order.
# ---------------------------------------------------------------------------
SEARCH_ENGINES = ("suche.t-online.|qwant.|suche.web.|search.yahoo.|baidu.|suche.gmx.|"
                  "suche.1und1.|suche.aol.|google.com / referral|startpage.com|search.brave.|yandex.")
NEWSLETTER_SOURCES = "newsletter|Newsletter|postwurfsendung"
NEWSLETTER_CAMPAIGNS = "y??_kw??_??_ns_"
SOCIAL_PAID_SOURCES = "facebook|instagram|pinterest|youtube"
SOCIAL_ORGANIC_SOURCES = "facebook|instagram|pinterest|youtube|strava|linkedin|IGShopping"
PSM_SOURCES = "psm|mydealz|beslist|trovaprezzi|shoptail|kelkoo"
AFFILIATE_SOURCES = "affiliate|awin|redbrain|ulligunde|bike-magazin|outdoor-professionell"
MANUFACTURER_SOURCES = ("manuf|edelrid|redchiliclimbing.com|sn-supernatural.com|komperdell.com|"
                        "vaude.com|trollkids.com|houdinisportswear.com|locator.suunto.com|"
                        "martini-sportswear.com|mountain-equipment.de|maier-sports.com|gonso.de|"
                        "brandwidgets.outtra.com|chillaz.com|alpina-sports.com")

DEFAULT_SOCIAL_SOURCES = "^(facebook|instagram|pinterest|reddit|twitter|linkedin)"
DEFAULT_PAID_SOCIAL_MEDIUMS = "^(cpc|ppc|paid)"
DEFAULT_SOCIAL_MEDIUMS = "^(social|social-network|social-media|sm|social network|social media)"
DEFAULT_EMAIL = "email|e-mail|e_mail|e mail"
DEFAULT_AFFILIATE = "affiliate|affiliates"
DEFAULT_PAID_MEDIUMS = "^(.*cp.*|ppc|paid.*)$"
DEFAULT_DISPLAY_MEDIUMS = "^(display|cpm|banner)$"
DEFAULT_SEARCH_MEDIUMS = "^(cpc|ppc|paidsearch)$"
DEFAULT_OTHER_AD_MEDIUMS = "^(cpv|cpa|cpp|content-text)$"
DEFAULT_VIDEO_MEDIUMS = "^(.*video.*)$"
DEFAULT_PUSH_MEDIUMS = "(mobile|notification|push$)"


@dataclass(frozen=True)
class Rule:
    label: str
    predicate: Callable[..., Column]


def _is(c: Column, v: str) -> Column:
    return c == F.lit(v)


CUSTOM_RULES: tuple[Rule, ...] = (
    Rule("Generic Paid Search Google", lambda s, m, c, p:
         _is(s, "google") & _is(m, "cpc") & (c.rlike("_2_|_3_") | _is(c, "generic_paid_search"))),
    Rule("Generic Paid Shopping Google", lambda s, m, c, p:
         _is(s, "google") & _is(m, "cpc")
         & (c.rlike("_4_|_6_") | c.isin("generic_paid_shopping", "generic_paid_pmax"))),
    Rule("Generic Paid Search Bing", lambda s, m, c, p:
         _is(s, "bing") & _is(m, "cpc") & ~c.rlike("_5_|_1_")),
    Rule("Brand Paid Search", lambda s, m, c, p:
         s.isin("google", "bing") & _is(m, "cpc") & (c.rlike("_1_") | _is(c, "brand_paid_search"))),
    Rule("Organic Search Home", lambda s, m, c, p:
         (s.rlike(SEARCH_ENGINES) | _is(m, "organic")) & _is(p, "start")),
    Rule("Organic Search Non-Home", lambda s, m, c, p:
         (s.rlike(SEARCH_ENGINES) | _is(m, "organic") | _is(c, "google_shopping_organic"))
         & (~p.isin("start", "magazine") | p.isNull())),
    Rule("Organic Search Magazin", lambda s, m, c, p:
         (s.rlike(SEARCH_ENGINES) | _is(m, "organic")) & _is(p, "magazine")),
    Rule("Newsletter", lambda s, m, c, p:
         s.rlike(NEWSLETTER_SOURCES) | c.rlike(NEWSLETTER_CAMPAIGNS)),
    Rule("Triggermail Parcellab", lambda s, m, c, p:
         s.rlike("parcellab") | m.rlike("parcellab")),
    Rule("Triggermail CRM", lambda s, m, c, p: _is(s, "triggermail") & _is(m, "email")),
    Rule("Social Paid", lambda s, m, c, p: s.rlike(SOCIAL_PAID_SOURCES) & m.isin("cpc")),
    Rule("Social Organic", lambda s, m, c, p:
         s.rlike(SOCIAL_ORGANIC_SOURCES) & m.isin("social", "referral", "Social")),
    Rule("PSM", lambda s, m, c, p: s.rlike(PSM_SOURCES) | c.like("%_outdoordeals")),
    Rule("Affiliate", lambda s, m, c, p: s.rlike(AFFILIATE_SOURCES)),
    Rule("Hersteller Links", lambda s, m, c, p: s.rlike(MANUFACTURER_SOURCES)),
    Rule("Display", lambda s, m, c, p:
         s.rlike("criteo") | s.isin("bsmart") | c.rlike("_5_")
         | (_is(s, "google") & _is(m, "cpc") & _is(c, "display"))),
    Rule("Referral", lambda s, m, c, p: _is(m, "referral")),
    Rule("Branding", lambda s, m, c, p:
         s.isin("taboola", "outbrain", "partner") | _is(m, "cpm") | _is(c, "_branding_")),
    Rule("Direct", lambda s, m, c, p: s.isNull() & m.isNull()),
)
CUSTOM_DEFAULT_LABEL = "Unassigned"

DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("Direct", lambda s, m, k: s.isNull() & m.isNull()),
    Rule("Direct", lambda s, m, k: _is(s, "(direct)") & (_is(m, "(none)") | _is(m, "(not set)"))),
    Rule("Paid Social", lambda s, m, k:
         s.rlike(DEFAULT_SOCIAL_SOURCES) & m.rlike(DEFAULT_PAID_SOCIAL_MEDIUMS)),
    Rule("Organic Social", lambda s, m, k:
         s.rlike(DEFAULT_SOCIAL_SOURCES) | m.rlike(DEFAULT_SOCIAL_MEDIUMS)
         | _is(k, "SOURCE_CATEGORY_SOCIAL")),
    Rule("Email", lambda s, m, k: m.rlike(DEFAULT_EMAIL) | s.rlike(DEFAULT_EMAIL)),
    Rule("Affiliates", lambda s, m, k: m.rlike(DEFAULT_AFFILIATE)),
    Rule("Paid Shopping", lambda s, m, k:
         _is(k, "SOURCE_CATEGORY_SHOPPING") & m.rlike(DEFAULT_PAID_MEDIUMS)),
    Rule("Paid Video", lambda s, m, k:
         (_is(k, "SOURCE_CATEGORY_VIDEO") & m.rlike(DEFAULT_PAID_MEDIUMS)) | _is(s, "dv360_video")),
    Rule("Display", lambda s, m, k: m.rlike(DEFAULT_DISPLAY_MEDIUMS) | _is(s, "dv360_display")),
    Rule("Paid Search", lambda s, m, k: m.rlike(DEFAULT_SEARCH_MEDIUMS)),
    Rule("Other Advertising", lambda s, m, k: m.rlike(DEFAULT_OTHER_AD_MEDIUMS)),
    Rule("Organic Search", lambda s, m, k: _is(m, "organic") | _is(k, "SOURCE_CATEGORY_SEARCH")),
    Rule("Organic Video", lambda s, m, k:
         m.rlike(DEFAULT_VIDEO_MEDIUMS) | _is(k, "SOURCE_CATEGORY_VIDEO")),
    Rule("Organic Shopping", lambda s, m, k: _is(k, "SOURCE_CATEGORY_SHOPPING")),
    Rule("Referral", lambda s, m, k: _is(m, "referral")),
    Rule("Audio", lambda s, m, k: _is(m, "audio")),
    Rule("SMS", lambda s, m, k: _is(m, "sms")),
    Rule("Push Notifications", lambda s, m, k: m.rlike(DEFAULT_PUSH_MEDIUMS) | _is(s, "firebase")),
)
DEFAULT_DEFAULT_LABEL = "(Other)"


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def apply_rules(rules, otherwise: str, *cols) -> Column:
    """Fold ``rules`` (first match wins) into one CASE expression."""
    args = [_col(c) for c in cols]
    expr = None
    for rule in rules:
        cond = rule.predicate(*args)
        expr = F.when(cond, F.lit(rule.label)) if expr is None else expr.when(cond, F.lit(rule.label))
    return expr.otherwise(F.lit(otherwise))


def custom_channel_group(source, medium, campaign, pagetype=None) -> Column:
    """Custom shop rule set; ``pagetype`` defaults to the literal 'none'."""
    p = F.lit("none") if pagetype is None else pagetype
    return apply_rules(CUSTOM_RULES, CUSTOM_DEFAULT_LABEL, source, medium, campaign, p)


def default_channel_group(source, medium, source_category) -> Column:
    """Default analytics rule set (source, medium, source category)."""
    return apply_rules(DEFAULT_RULES, DEFAULT_DEFAULT_LABEL, source, medium, source_category)

