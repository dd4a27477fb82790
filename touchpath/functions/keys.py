"""Hash keys: user key, session key and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marker the surrogate-key convention writes for a NULL
# member, so keys equal those built by the original SQL models.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def b64md5(c: Column) -> Column:
    """Base64 text of the raw 16 MD5 bytes; NULL in, NULL out."""
    return F.base64(F.unhex(F.md5(c.cast("string"))))


def user_key(user_id: Column, user_pseudo_id: Column) -> Column:
    """Logged-in id first, then the device id; NULL when consent is missing."""
    return (F.when(user_id.isNotNull(), b64md5(user_id))
             .when(user_pseudo_id.isNotNull(), b64md5(user_pseudo_id)))


def session_key(ukey: Column, ga_session_id: Column) -> Column:
    """``concat`` propagates NULL: no user key or no session id -> NULL key."""
    return b64md5(F.concat(ukey.cast("string"), ga_session_id.cast("string")))


def surrogate_key(*cols: Column) -> Column:
    """Hex MD5 over the members joined by '-', NULL members marked."""
    parts = [F.coalesce(c.cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def items_json(items: Column) -> Column:
    """JSON text of the ``items`` array; a missing array hashes like an empty one."""
    return F.coalesce(F.to_json(items, {"ignoreNullFields": "false"}), F.lit("[]"))
