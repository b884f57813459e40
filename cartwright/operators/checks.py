"""Data checks: failing rows, one-pass summaries, fail-fast runs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class CheckFailed(AssertionError):
    """A check found failing rows in a fail-fast run."""


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    values: tuple[Any, ...] = ()
    low: Any = None
    high: Any = None
    strict: bool = False
    pattern: str = ""

    def violation(self) -> Column:
        """Condition a failing row meets.  NULL fails not_null only."""
        column = F.col(self.column)
        if self.kind == "not_null":
            return column.isNull()
        if self.kind == "accepted_values":
            return ~column.isin(*self.values)
        if self.kind == "regex":
            return ~column.rlike(self.pattern)
        if self.kind == "between":
            sides = []
            if self.low is not None:
                sides.append(column <= F.lit(self.low) if self.strict else column < F.lit(self.low))
            if self.high is not None:
                sides.append(column >= F.lit(self.high) if self.strict else column > F.lit(self.high))
            return reduce(lambda a, b: a | b, sides, F.lit(False))
        raise ValueError(f"{self.kind} is not a row condition")


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str) -> Check:
    return Check("unique", column)


def accepted(column: str, *values: Any) -> Check:
    return Check("accepted_values", column, values=values)


def between(column: str, low: Any = None, high: Any = None, strict: bool = False) -> Check:
    return Check("between", column, low=low, high=high, strict=strict)


def matches(column: str, pattern: str) -> Check:
    return Check("regex", column, pattern=pattern)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(not_null(column).violation())


def check_accepted(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.where(accepted(column, *values).violation())


def check_between(
    df: DataFrame, column: str, low: Any = None, high: Any = None, strict: bool = False
) -> DataFrame:
    return df.where(between(column, low, high, strict).violation())


def check_regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(matches(column, pattern).violation())


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Repeated key values with their counts; rows with a NULL key pass."""
    present = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    counted = df.where(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where("n_rows > 1")


def check_parsable(df: DataFrame, column: str, data_type: str) -> DataFrame:
    """Rows whose text is present but cannot be read as ``data_type``."""
    return df.where(F.col(column).isNotNull() & F.col(column).try_cast(data_type).isNull())


def summarize_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check: table_name, check_name, column_name, n_failed.

    All row conditions share one pass over the table; a uniqueness check adds
    its own aggregation and counts the repeated values.
    """
    parts = []
    simple = [c for c in checks if c.kind != "unique"]
    if simple:
        counts = df.agg(*(F.count_if(c.violation()).alias(f"n{i}") for i, c in enumerate(simple)))
        rows = [
            F.struct(
                F.lit(c.kind).alias("check_name"),
                F.lit(c.column).alias("column_name"),
                F.col(f"n{i}").alias("n_failed"),
            )
            for i, c in enumerate(simple)
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    for c in checks:
        if c.kind == "unique":
            repeated = check_unique(df, [c.column]).agg(F.count(F.lit(1)).alias("n_failed"))
            parts.append(
                repeated.select(
                    F.lit(c.kind).alias("check_name"), F.lit(c.column).alias("column_name"), "n_failed"
                )
            )
    union = reduce(DataFrame.unionByName, parts)
    return union.select(F.lit(table).alias("table_name"), "check_name", "column_name", "n_failed")


def run_checks(df: DataFrame, table: str, checks: Sequence[Check], fail_fast: bool = False) -> DataFrame:
    """The summary; with ``fail_fast`` it is computed now and any finding raises."""
    summary = summarize_checks(df, table, checks)
    if fail_fast:
        found = summary.where("n_failed > 0").orderBy("check_name", "column_name").collect()
        if found:
            raise CheckFailed(
                "; ".join(f"{table}.{r.column_name} {r.check_name}: {r.n_failed}" for r in found)
            )
    return summary


def observed(df: DataFrame, table: str, checks: Sequence[Check]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``df`` with its row conditions counted by whatever action reads it as a whole, such as its write, and a function that
    gives ``summarize_checks`` afterwards.

    No scan is added. Only row conditions can be counted in passing, so uniqueness checks are refused.
    """
    if any(c.kind == "unique" for c in checks):
        raise ValueError("a uniqueness check needs a grouping of its own: use summarize_checks")
    counter = Observation(f"{table} checks")
    counts = [F.count_if(c.violation()).alias(f"n{k}") for k, c in enumerate(checks)]

    def summary() -> DataFrame:
        found = counter.get
        rows = [(table, c.kind, c.column, found[f"n{k}"]) for k, c in enumerate(checks)]
        return df.sparkSession.createDataFrame(rows, "table_name string, check_name string, column_name string, n_failed long")

    return df.observe(counter, *counts), summary


def assert_row_count(df: DataFrame, name: str, minimum: int) -> DataFrame:
    """One row telling whether the frame has at least ``minimum`` rows."""
    enough = F.when(F.col("actual_rows") >= minimum, "PASS").otherwise("FAIL")
    return df.agg(F.count(F.lit(1)).alias("actual_rows")).select(
        F.lit(name).alias("model_name"),
        "actual_rows",
        F.lit(minimum).cast("long").alias("expected_min_rows"),
        enough.alias("result"),
    )
