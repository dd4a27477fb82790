"""Traffic-source struct and the session -> user precedence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRAFFIC_FIELDS = ("source", "medium", "campaign", "page_pagetype")


def traffic_struct(source="source", medium="medium", campaign="campaign",
                   page_pagetype="page_pagetype") -> Column:
    """Struct of the four fields, or NULL (= direct) when source and medium are both NULL.

    A campaign alone does not make a source.
    """
    s, m, c, p = (F.col(x) if isinstance(x, str) else x
                  for x in (source, medium, campaign, page_pagetype))
    return F.when(F.coalesce(s, m).isNotNull(),
                  F.struct(s.alias("source"), m.alias("medium"),
                           c.alias("campaign"), p.alias("page_pagetype")))


def preferred_field(first: Column, fallback: Column, field: str) -> Column:
    """``first.field`` when the struct ``first`` exists, else ``fallback.field``.

    The test is on the struct, never on the field: a session struct with a
    NULL campaign is not filled from the user's struct.
    """
    return (F.when(first.isNotNull(), first[field])
             .when(fallback.isNotNull(), fallback[field]))
