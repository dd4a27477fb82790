"""Key/value event parameters (``event_params`` array of structs).

A parameter is looked up positionally: ``array_position`` over the key array
finds the first entry with the key, ``get`` reads that entry's value slot
(NULL when the key is absent, the array empty or NULL).  Both are generated
code (a lambda-based ``filter`` would be interpreted per row), the key array
is shared between lookups by subexpression elimination, and only the value
slots actually read are decoded from Parquet (nested-schema pruning).  No
explode, no shuffle, no sub-query.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRING, INT = "string_value", "int_value"


def event_param(key: str, value_type: str = STRING, params: str | Column = "event_params",
                on_duplicate: str = "first") -> Column:
    """Value of parameter ``key``; NULL when the key is absent or the array is NULL.

    ``on_duplicate='first'`` takes the first entry when a key repeats,
    ``'error'`` raises instead (the behaviour of a scalar sub-query).
    ``get`` (not ``[0]``) keeps an empty match from raising under ANSI mode.
    """
    arr = F.col(params) if isinstance(params, str) else params
    pos = F.array_position(arr["key"], F.lit(key))          # 1-based, 0 when absent
    value = F.get(arr["value"][value_type], (pos - 1).cast("int"))
    if on_duplicate == "error":
        n = F.size(F.filter(arr["key"], lambda k: k == F.lit(key)))
        return F.when(n > 1, F.raise_error(F.lit(f"event parameter {key!r} occurs more than once"))
                      ).otherwise(value)
    if on_duplicate != "first":
        raise ValueError(on_duplicate)
    return value


def engaged_flag(params: str | Column = "event_params") -> Column:
    """1 when ``session_engaged`` is the string '1', else NULL."""
    return F.when(event_param("session_engaged", STRING, params) == F.lit("1"), F.lit(1))
