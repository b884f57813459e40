"""Schemas from short text; needs no running session."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

TYPES: dict[str, DataType] = {
    "boolean": BooleanType(),
    "date": DateType(),
    "double": DoubleType(),
    "int": IntegerType(),
    "long": LongType(),
    "string": StringType(),
    "timestamp_ntz": TimestampNTZType(),
}


def struct(columns: str) -> StructType:
    """``"name type, name type!"``; an exclamation mark means NOT NULL."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema.add(name, TYPES[kind.rstrip("!")], nullable=not kind.endswith("!"))
    return schema
