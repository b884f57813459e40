"""Text labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwright.functions.bands import below

# Payment groups; the first fragment found in the method decides.
METHOD_FRAGMENTS = (("card", "card"), ("transfer", "bank_transfer"), ("wallet", "e_wallet"))
METHOD_NAMES = {"cod": "cod", "paylater": "bnpl"}
OTHER_METHOD = "other"

METHOD_GROUPS = sorted({*(label for _, label in METHOD_FRAGMENTS), *METHOD_NAMES.values(), OTHER_METHOD})

# Selling price under which each tier applies.
TIER_LIMITS = ((100_000, "budget"), (500_000, "mid_range"), (1_500_000, "premium"))
TOP_TIER = "luxury"


def sentence_case(text: Column) -> Column:
    """Trimmed, lower case, first letter capital."""
    clean = F.lower(F.trim(text))
    return F.concat(F.upper(F.left(clean, F.lit(1))), F.substring(clean, F.lit(2), F.length(clean)))


def payment_method_group(method: Column) -> Column:
    group = F
    for fragment, label in METHOD_FRAGMENTS:
        group = group.when(method.contains(fragment), label)
    for name, label in METHOD_NAMES.items():
        group = group.when(method == name, label)
    return group.otherwise(OTHER_METHOD)


def price_tier(price: Column) -> Column:
    """A NULL price reaches no limit and so falls in the top tier."""
    return below(price, TIER_LIMITS, TOP_TIER)
