"""JSON text and arrays to columns and rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ddl(data_type: str) -> T.DataType:
    return T._parse_datatype_string(data_type)


def json_struct(column: Column | str, fields: Mapping[str, str]) -> Column:
    """Parse JSON text once, reading only ``fields`` (key -> type).

    Keys are taken literally, so ``a.b`` is a key with a dot.  Malformed text
    gives NULL fields instead of an error.
    """
    column = F.col(column) if isinstance(column, str) else column
    schema = T.StructType([T.StructField(key, _ddl(kind)) for key, kind in fields.items()])
    return F.from_json(column, schema)


def extract(df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add one column per entry of ``fields``: name -> (key, type).

    One parse per row, whatever the number of fields; the parsed struct does
    not leave the projection.
    """
    parsed = df.withColumn("_parsed", json_struct(column, {key: kind for key, kind in fields.values()}))
    added = {name: F.col("_parsed").getField(key) for name, (key, _) in fields.items()}
    return parsed.withColumns(added).drop("_parsed")


def extract_path(column: Column | str, path: str, data_type: str) -> Column:
    """One value below a JSON path, through the VARIANT type; a value that
    does not convert gives NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return F.try_variant_get(F.try_parse_json(column), path, data_type)


def flatten(df: DataFrame, column: str, alias: str) -> DataFrame:
    """One row per array element; rows without elements disappear."""
    return df.withColumn(alias, F.explode(column))


def any_element(column: str, field: str, value) -> Column:
    """True when an array of structs has an element whose field equals value."""
    return F.array_contains(F.col(column).getField(field), value)


def state_of(column: Column | str) -> Column:
    """Scheduling state given either as plain text or as a JSON object with a
    ``state`` key in either case."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(
        F.get_json_object(column, "$.state"), F.get_json_object(column, "$.STATE"), column
    )
