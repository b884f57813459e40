"""The two generation labellings: by birth year and by age."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column

from cartwright.functions.bands import at_least, below


# First birth year of each cohort.
@dataclass(frozen=True)
class CohortYears:
    first_years: tuple[tuple[int, str], ...] = (
        (1997, "Gen Z"),
        (1981, "Millennial"),
        (1965, "Gen X"),
        (1946, "Boomer"),
    )
    earlier: str = "Silent Generation"


# Age under which each label applies; older customers are boomers.
AGE_LIMITS = ((25, "gen_z"), (40, "millennial"), (56, "gen_x"))
OLDEST_LABEL = "boomer"


def generation_cohort(birth_year: Column, config: CohortYears = CohortYears()) -> Column:
    return at_least(birth_year, config.first_years, config.earlier)


def cohort_by_age(age_years: Column) -> Column:
    return below(age_years, AGE_LIMITS, OLDEST_LABEL)
