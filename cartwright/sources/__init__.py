"""Reading, loading and writing Parquet datasets."""

from cartwright.sources.load import full_refresh, incremental_load, materialize, rebuild, replace_table
from cartwright.sources.parquet import read_partitioned, read_table, write_flat, write_partitioned
from cartwright.sources.publish import replace_partitions
from cartwright.sources.registry import SOURCES, SourceSpec
from cartwright.sources.storage import files_exist, path_exists, table_exists

__all__ = [
    "SOURCES",
    "SourceSpec",
    "files_exist",
    "full_refresh",
    "incremental_load",
    "materialize",
    "path_exists",
    "read_partitioned",
    "read_table",
    "rebuild",
    "replace_partitions",
    "replace_table",
    "table_exists",
    "write_flat",
    "write_partitioned",
]
