"""Deterministic entity ids: UUID version 5, as a Catalyst expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityforge.functions.text import strip

#: Fixed value: the namespace of all entity ids.
NAMESPACE = "6f6d5f2a-6e9b-4c3a-9a1a-8f2b1e7c9d10"


def uuid5(name: Column, namespace: str = NAMESPACE) -> Column:
    """UUIDv5 of a text in a namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.lower(F.lpad(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)), 2, "0"))
    groups = (F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 19, 2)), F.substring(h, 21, 12))
    return F.concat_ws("-", *groups)


def entity_id(entity_type: Column, name: Column, url: Column) -> Column:
    """Id of (type, name, url): each stripped, in lower case, null as ''."""
    parts = [F.lower(strip(F.coalesce(c, F.lit("")))) for c in (entity_type, name, url)]
    return uuid5(F.concat_ws("|", *parts))
