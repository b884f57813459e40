"""Recency / frequency / monetary scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column

from cartwright.functions.bands import at_least, at_most


# Default score thresholds, from the best band (score 5) down to
# score 2; everything beyond the last bound scores 1.
@dataclass(frozen=True)
class RfmConfig:
    recency_days: tuple[int, int, int, int] = (30, 60, 90, 180)
    frequency_orders: tuple[int, int, int, int] = (10, 6, 3, 2)
    monetary_idr: tuple[int, int, int, int] = (5_000_000, 2_000_000, 1_000_000, 500_000)
    segment_minimums: tuple[tuple[int, str], ...] = (
        (13, "Champion"),
        (10, "Loyal Customer"),
        (7, "Potential Loyalist"),
        (4, "At Risk"),
    )
    lowest_segment: str = "Lost"


def _scored(bounds: tuple[int, ...]) -> list[tuple[int, int]]:
    return list(zip(bounds, (5, 4, 3, 2), strict=True))


def rfm_recency_score(days: Column, config: RfmConfig = RfmConfig()) -> Column:
    return at_most(days, _scored(config.recency_days), 1)


def rfm_frequency_score(orders: Column, config: RfmConfig = RfmConfig()) -> Column:
    return at_least(orders, _scored(config.frequency_orders), 1)


def rfm_monetary_score(amount: Column, config: RfmConfig = RfmConfig()) -> Column:
    return at_least(amount, _scored(config.monetary_idr), 1)


def rfm_segment_label(score: Column, config: RfmConfig = RfmConfig()) -> Column:
    return at_least(score, config.segment_minimums, config.lowest_segment)
