"""Money and ratio helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rupiah per unit of foreign currency.
FX_RATES: Mapping[str, float] = {"USD": 15800, "SGD": 11900}


def to_idr(amount: Column, currency: Column, rates: Mapping[str, float] = FX_RATES) -> Column:
    """Amount in rupiah; a currency without a rate passes through unchanged."""
    rate = F.lit(None).cast("double")
    for code, per_unit in rates.items():
        rate = F.when(F.upper(currency) == code, F.lit(float(per_unit))).otherwise(rate)
    return F.coalesce(amount * rate, amount)


def cents_to_idr(cents: Column) -> Column:
    return F.round(cents.cast("double") / 100, 2)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Four-decimal ratio; NULL when the denominator is zero or NULL."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), 4)
