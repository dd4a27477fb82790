"""Page path from a page URL (own site's scheme and host stripped)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# fixed value: the pattern of the own site's origin
def site_prefix(site: str) -> str:
    """Anchored pattern of the own site's origin (2-letter TLD, optional 2nd level)."""
    return rf"^http[s]?://www.{site}.[a-z][a-z][.]?[a-z]?[a-z]?"


def page_path(location: Column, site: str) -> Column:
    """Path without query string; foreign hosts keep their origin."""
    return F.regexp_replace(F.substring_index(location, "?", 1), site_prefix(site), "")


def page_path_and_querystring(location: Column, site: str) -> Column:
    return F.regexp_replace(location, site_prefix(site), "")
