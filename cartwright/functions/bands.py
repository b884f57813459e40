"""Threshold ladders: the first rung a value reaches decides the label."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(reaches: Callable[[Any], Column], rungs: Sequence[tuple[Any, Any]], otherwise: Any) -> Column:
    """CASE over ``(bound, label)`` rungs; a NULL value reaches none of them."""
    expression = F
    for bound, label in rungs:
        expression = expression.when(reaches(bound), F.lit(label))
    return expression.otherwise(F.lit(otherwise))


def at_least(value: Column, rungs: Sequence[tuple[Any, Any]], otherwise: Any) -> Column:
    return ladder(lambda bound: value >= bound, rungs, otherwise)


def at_most(value: Column, rungs: Sequence[tuple[Any, Any]], otherwise: Any) -> Column:
    return ladder(lambda bound: value <= bound, rungs, otherwise)


def below(value: Column, rungs: Sequence[tuple[Any, Any]], otherwise: Any) -> Column:
    return ladder(lambda bound: value < bound, rungs, otherwise)


def labelled(value: Column, labels: Mapping[Any, Any], otherwise: Any = None) -> Column:
    """CASE over exact values."""
    return ladder(lambda known: value == known, list(labels.items()), otherwise)
