"""Which facts a late dimension version changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.operators.hot import HotKeys, find_hot
from cartwright.operators.neighbours import with_neighbour
from cartwright.operators.pit import pit_join


def changed_ranges(
    versions: DataFrame, changed: DataFrame, key: str, valid_from: str, hot: DataFrame | None = None
) -> DataFrame:
    """``key, _since, _before``: the time from each changed version's start to the next later start of its key.

    ``versions`` are all versions, the changed ones among them.  Where a version ends at the next one's start, no
    fact outside these ranges can meet another version than before: a new version
    cuts its predecessor at its own start and is cut itself at the next start.  Ranges of a key do not overlap.
    """
    starts = versions.select(key, F.col(valid_from).alias("_since")).where("_since IS NOT NULL")
    theirs = starts.join(changed.select(key).distinct(), key, "left_semi").distinct()
    ranges = with_neighbour(theirs, key, "_since", {"_before": "_since"}, hot=hot)
    new = changed.select(key, F.col(valid_from).alias("_since")).distinct()
    return ranges.join(new, [key, "_since"], "left_semi")


def facts_in_changed_ranges(
    facts: DataFrame,
    versions: DataFrame,
    changed: DataFrame,
    key: str,
    ts: str,
    valid_from: str,
    day: str | None = None,
    limits: HotKeys = HotKeys(),
) -> DataFrame:
    """The facts that a late version may have changed, once each: a range semi-join.

    The ranges of few changed versions are small, so Spark sends them to the facts instead of shuffling those.
    ``day`` names a date column of the facts; days before the first range are cut off by a literal, which reaches the scan.
    """
    hot = find_hot(changed, key, limits)
    ranges = changed_ranges(versions, changed, key, valid_from, hot)
    if day is not None:
        first = ranges.agg(F.min("_since")).first()[0]
        if first is None:
            return facts.where(F.lit(False))
        facts = facts.where(F.col(day) >= F.lit(first.date()))
    return pit_join(facts, ranges, key, ts, "_since", "_before", how="inner", hot=hot)
