"""Column functions: business rules that stay inside Catalyst expressions."""

from cartwright.functions.cohorts import CohortYears, cohort_by_age, generation_cohort
from cartwright.functions.dates import date_spine, minutes_between, years_between
from cartwright.functions.flags import flag, is_late_arriving
from cartwright.functions.keys import surrogate_key
from cartwright.functions.money import FX_RATES, cents_to_idr, safe_divide, to_idr
from cartwright.functions.scoring import (
    RfmConfig,
    rfm_frequency_score,
    rfm_monetary_score,
    rfm_recency_score,
    rfm_segment_label,
)
from cartwright.functions.text import payment_method_group, price_tier, sentence_case

__all__ = [
    "FX_RATES",
    "CohortYears",
    "RfmConfig",
    "cents_to_idr",
    "cohort_by_age",
    "date_spine",
    "flag",
    "generation_cohort",
    "is_late_arriving",
    "minutes_between",
    "payment_method_group",
    "price_tier",
    "rfm_frequency_score",
    "rfm_monetary_score",
    "rfm_recency_score",
    "rfm_segment_label",
    "safe_divide",
    "sentence_case",
    "surrogate_key",
    "to_idr",
    "years_between",
]
