"""Flat and date-partitioned Parquet datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A flat dataset; a given schema saves the footer-reading job."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_partitioned(
    spark: SparkSession, base: str, partition_col: str, schema: StructType | None = None
) -> DataFrame:
    """A dataset laid out as ``<base>/<partition_col>=YYYY-MM-DD/``.

    Filters on the partition column (a DATE) select folders before any file
    is opened.
    """
    if schema is not None and partition_col not in schema.fieldNames():
        schema = StructType([*schema.fields]).add(partition_col, DateType())
    df = read_table(spark, base, schema)
    if dict(df.dtypes).get(partition_col) != "date":
        raise ValueError(f"{base} is not partitioned by a date column {partition_col}")
    return df


def write_flat(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Bring equal values together before a write, without one giant task.

    The rebalance hint lets AQE split a value that holds too many rows and
    merge those that hold few, so files come out near the advisory size.
    """
    return df.hint("rebalance", *columns)


def write_partitioned(
    df: DataFrame, base: str, ts_col: str, partition_col: str, mode: str = "overwrite"
) -> None:
    """Write one folder per calendar day of ``ts_col``."""
    day = F.col(ts_col).cast("timestamp_ntz").cast("date")
    dated = df.withColumn(partition_col, day)
    balanced(dated, partition_col).write.mode(mode).partitionBy(partition_col).parquet(base)
