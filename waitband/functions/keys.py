"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SURROGATE_NULL_TOKEN


def surrogate_key(*cols, null_token: str = SURROGATE_NULL_TOKEN, sep: str = "-") -> Column:
    """md5 of the '-'-joined string forms; NULL parts become ``null_token``."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null_token))
             for c in cols]
    return F.md5(F.concat_ws(sep, *parts))
