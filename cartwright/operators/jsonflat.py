"""Flattening a JSON text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwright.schema import struct


def flatten_json(df: DataFrame, column: str, schema: StructType | str) -> DataFrame:
    """Replace a JSON column by one column per field of ``schema``."""
    if isinstance(schema, str):
        schema = struct(schema)
    rest = [c for c in df.columns if c != column]
    parsed = F.from_json(F.col(column), schema)
    return df.withColumn("_json", parsed).select(*rest, *(F.col("_json")[n].alias(n) for n in schema.names))


def flatten_open_json(
    df: DataFrame, column: str, schema: StructType | str, rest: str = "other_fields", rejected: str = "rejected_text"
) -> DataFrame:
    """``flatten_json`` that loses nothing: keys outside ``schema`` go to ``rest``, broken text to ``rejected``.

    ``rest`` is a map from key to JSON text, NULL where there is none, so a source may add fields before
    the schema knows them. ``rejected`` holds text that is no JSON object, whose fields are all NULL.
    """
    if isinstance(schema, str):
        schema = struct(schema)
    known = [F.lit(name) for name in schema.names]
    variant = F.try_parse_json(F.col(column))
    is_object = F.coalesce(F.schema_of_variant(variant).startswith("OBJECT"), F.lit(False))
    members = F.from_json(F.when(is_object, F.to_json(variant)), "map<string,string>")
    others = F.map_filter(members, lambda key, _: ~key.isin(*known))
    added = {
        rest: F.when(F.cardinality(others) > 0, others),
        rejected: F.when(F.col(column).isNotNull() & ~is_object, F.col(column)),
    }
    kept = [c for c in df.columns if c != column]
    whole = df.withColumns(added).withColumn(column, F.when(is_object, F.col(column)))
    flat = flatten_json(whole, column, schema)
    return flat.select(*kept, *schema.names, *added)
