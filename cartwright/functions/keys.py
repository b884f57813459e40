"""Hashed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for NULL inside a hashed key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 of the columns' text joined by '-'."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_TOKEN)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))
