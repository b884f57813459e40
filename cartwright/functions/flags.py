"""Boolean flags: an unknown condition is not a finding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def is_late_arriving(paid_at: Column, ordered_at: Column, grace_minutes: int = 0) -> Column:
    """Paid before the order existed, beyond the grace period (NULL if unknown)."""
    if grace_minutes > 0:
        ordered_at = ordered_at - F.make_dt_interval(mins=F.lit(grace_minutes))
    return paid_at < ordered_at
