"""Timestamps that sources give as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"\d{4}-\d\d-\d\d"
_ZONED = rf"^{_DATE}[T ]\d\d:\d\d(:\d\d([.,]\d+)?)?(Z|[+-]\d\d:?\d\d)$"
_COMPACT = r"^\d{8}T\d{6}(Z|[+-]\d\d:?\d\d)$"


def parse_zoned(c: Column) -> Column:
    """ISO 8601 timestamps with a zone; everything else, dates and mail dates included, is null."""
    text = F.replace(F.replace(c, F.lit(","), F.lit(".")), F.lit("Z"), F.lit("+00:00"))
    text = F.regexp_replace(text, r"([+-]\d\d)(\d\d)$", "$1:$2")
    return F.when(c.rlike(_ZONED), F.try_to_timestamp(text)).when(c.rlike(_COMPACT), F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmmssXXX")))


def is_recent(c: Column, now: Column, days: int = 30) -> Column:
    """Whether a zoned timestamp lies at most `days` whole days before `now`, or after it."""
    age = F.floor((F.unix_micros(now) - F.unix_micros(parse_zoned(c))) / F.lit(86_400_000_000))
    return F.coalesce(age <= days, F.lit(False))
