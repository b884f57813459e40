"""Replacing some partitions of a Parquet table without risking the rest.

Rows are written once, by partition, to a hidden folder inside the table. When they are complete, a plan is stored
beside them, and the touched partitions are exchanged by renames. A job lost in
between is finished by the next call, which finds the plan and goes on with the renames that are left; doing so twice gives the
same table. The plan lies below the table, so any process that writes the table finds it.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StructType

from cartwright.session import shared_dir
from cartwright.sources import storage
from cartwright.sources.keyindex import index_rows, read_index, write_index
from cartwright.sources.parquet import balanced

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
SCHEMA_FILE = "_schema.json"
#: Folders a table may have: days of some centuries.
MOST_PARTITIONS = 200_000
PartitionValue = dt.date | str | None


def _pending_root(target: str) -> str:
    return f"{target.rstrip('/')}/_pending"


def _folder_value(value: PartitionValue) -> str:
    if value is None:
        return NULL_PARTITION
    return value.isoformat() if isinstance(value, dt.date) else value


def partition_folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """The partitions below ``path`` as their folders name them, without opening a file."""
    return [name.partition("=")[2] for name in storage.folders(spark, path) if name.startswith(f"{column}=")]


def value_of(folder: str, kind: DataType) -> PartitionValue:
    if folder == NULL_PARTITION:
        return None
    return dt.date.fromisoformat(folder) if isinstance(kind, DateType) else unquote(folder)


@contextmanager
def written_copy(spark: SparkSession, df: DataFrame) -> Iterator[DataFrame]:
    """``df`` computed once and stored in the shared folder while in use.

    For frames with several uses: each reads only its columns of the copy.
    """
    path = f"{shared_dir(spark)}/cartwright-copies/{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        storage.delete(spark, path)


def in_partitions(column: str, values: Iterable[PartitionValue]) -> Column:
    """Filter on literal partition values, so only their folders are read."""
    values = list(values)
    named = [v for v in values if v is not None]
    if named and all(isinstance(v, dt.date) for v in named):
        listed = ", ".join(f"DATE '{day}'" for day in sorted(named))
        condition = F.expr(f"{column} IN ({listed})")
    else:
        condition = F.col(column).isin(named)
    return condition | F.col(column).isNull() if None in values else condition


def distinct_values(df: DataFrame, column: str) -> list[PartitionValue]:
    """The distinct partition values of ``df``.

    Collected to the driver: one value per calendar day or month, which the
    calendar bounds, whatever the number of rows.  A column with more values is no partition column and is refused.
    """
    values = [row[0] for row in df.select(column).distinct().limit(MOST_PARTITIONS + 1).collect()]
    if len(values) > MOST_PARTITIONS:
        raise ValueError(f"{column} has more than {MOST_PARTITIONS} values: it cannot name partitions")
    return values


def finish_pending(spark: SparkSession, target: str) -> bool:
    """Publish what an interrupted call left complete; drop what it left partial.

    Call it before planning anything that reads ``target``.
    """
    root, live = _pending_root(target), target.rstrip("/")
    text = storage.read_text(spark, f"{root}/plan.json")
    if text is None:
        storage.delete(spark, root)
        return False
    plan = json.loads(text)
    column = plan["column"]
    for folder in plan["filled"]:
        storage.move(spark, f"{root}/rows/{column}={folder}", f"{live}/{column}={folder}")
    for folder in plan["emptied"]:
        storage.delete(spark, f"{live}/{column}={folder}")
    storage.write_text(spark, f"{live}/{SCHEMA_FILE}", json.dumps(plan["schema"]))
    stale = {*plan["filled"], *plan["emptied"]}
    before = read_index(spark, target)
    after = {name: e for name, e in before.items() if name not in stale} | plan["index"]
    if after != before:
        write_index(spark, target, after)
    storage.delete(spark, root)
    return True


def stage(
    spark: SparkSession, df: DataFrame, target: str, partition_col: str, mode: str = "overwrite", arranged: bool = False
) -> DataFrame:
    """Write rows to the table's pending folder; what was written, as a frame.  ``append`` adds to what is there.

    Rows that are ``arranged`` come from ``balanced`` already.
    """
    root = _pending_root(target)
    if storage.path_exists(spark, f"{root}/plan.json"):
        raise RuntimeError(f"an interrupted write of {target} is waiting: call finish_pending first")
    if mode == "overwrite":
        storage.delete(spark, root)
    ready = df if arranged else balanced(df, partition_col)
    ready.write.mode(mode).partitionBy(partition_col).parquet(f"{root}/rows")
    return spark.read.schema(df.schema).parquet(f"{root}/rows").select(*df.columns)


def publish(
    spark: SparkSession,
    target: str,
    schema: StructType,
    partition_col: str,
    touched: Iterable[PartitionValue] = (),
    keys: Sequence[str] | None = None,
) -> list[PartitionValue]:
    """Make the staged rows the whole content of their own and the ``touched`` partitions.

    With ``keys`` the partitions' keys are indexed in the same commit.
    """
    root = _pending_root(target)
    kind = schema[partition_col].dataType
    filled = partition_folders(spark, f"{root}/rows", partition_col)
    values = {value_of(folder, kind) for folder in filled}
    entries = {}
    if keys is not None and filled:
        staged = spark.read.schema(schema).parquet(f"{root}/rows")
        names = {value_of(folder, kind): folder for folder in filled}
        entries = index_rows(spark, target, staged, keys, partition_col, names.get)
    plan = {
        "column": partition_col,
        "filled": filled,
        "emptied": sorted(_folder_value(v) for v in set(touched) - values),
        "schema": schema.jsonValue(),
        "index": entries,
    }
    storage.write_text(spark, f"{root}/plan.json", json.dumps(plan))
    finish_pending(spark, target)
    return sorted(values | set(touched), key=str)


def replace_partitions(
    spark: SparkSession,
    df: DataFrame,
    target: str,
    partition_col: str,
    touched: Iterable[PartitionValue] = (),
) -> list[PartitionValue]:
    """Make ``df`` the whole content of its own and the ``touched`` partitions.

    ``df`` may read from ``target``.  A touched partition without rows in
    ``df`` disappears; all others are left alone.  Returns what was replaced.
    """
    stage(spark, df, target, partition_col)
    return publish(spark, target, df.schema, partition_col, touched)


def read_target(spark: SparkSession, target: str) -> DataFrame | None:
    """The table at ``target``, or None when nothing was ever written there.

    Partitions written before a column was added read it as NULL, because the
    newest schema is kept beside the data; no footer has to be opened.
    """
    kept = storage.read_text(spark, f"{target.rstrip('/')}/{SCHEMA_FILE}")
    if kept is not None:
        schema = StructType.fromJson(json.loads(kept))
        return spark.read.schema(schema).parquet(target).select(*schema.fieldNames())
    if not storage.has_parquet(spark, target):
        return None
    return spark.read.parquet(target)
