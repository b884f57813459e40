"""Enforced output schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


class ContractBreach(ValueError):
    """The columns or types differ from the contract."""


def _required(field: StructField) -> Column:
    column = F.col(field.name)
    broken = F.raise_error(F.lit(f"contract: {field.name} must not be null"))
    return F.when(column.isNull(), broken.cast(field.dataType)).otherwise(column).alias(field.name)


def enforce_contract(df: DataFrame, contract: StructType) -> DataFrame:
    """The frame in contract order; names and types are checked now, NOT NULL
    (non-nullable fields) row by row when the result is computed."""
    missing = [n for n in contract.names if n not in df.columns]
    extra = [n for n in df.columns if n not in contract.names]
    if missing or extra:
        raise ContractBreach(f"missing columns {missing}, unexpected columns {extra}")
    wrong = [
        f"{f.name}: {df.schema[f.name].dataType.simpleString()} is not {f.dataType.simpleString()}"
        for f in contract
        if df.schema[f.name].dataType != f.dataType
    ]
    if wrong:
        raise ContractBreach("; ".join(wrong))
    return df.select(*(F.col(f.name) if f.nullable else _required(f) for f in contract))
