"""Schema inference from JSON text, as one distributed aggregate.

``schema_of_variant_agg`` merges the schema of every value map-side, so only one string per task
is shuffled and one row comes back, however many rows were read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUOTED = re.compile(r"`(?:[^`]|``)*`")
_OBJECT = re.compile(r"\bOBJECT<")
_EMPTY_OBJECT = re.compile(r"\bOBJECT<>")


def _to_ddl(variant_schema: str) -> str:
    """Turn ``OBJECT<a: BIGINT>`` into ``STRUCT<a: BIGINT>``, leaving quoted names alone."""
    parts, last = [], 0
    for quoted in _QUOTED.finditer(variant_schema):
        parts.append((variant_schema[last : quoted.start()], False))
        parts.append((quoted.group(), True))
        last = quoted.end()
    parts.append((variant_schema[last:], False))
    return "".join(
        text if is_name else _OBJECT.sub("STRUCT<", _EMPTY_OBJECT.sub("STRUCT<>", text))
        for text, is_name in parts
    )


def _plain(data_type: T.DataType, keep_objects: bool) -> T.DataType:
    if isinstance(data_type, (T.NullType, T.VariantType)):
        return T.StringType()
    if isinstance(data_type, (T.DecimalType, T.FloatType)):
        return T.DoubleType()
    if isinstance(data_type, T.ArrayType):
        if isinstance(data_type.elementType, T.NullType):
            return T.ArrayType(T.StringType()) if keep_objects else T.StringType()
        return T.ArrayType(_plain(data_type.elementType, keep_objects))
    if isinstance(data_type, T.StructType):
        if not keep_objects or not data_type.fields:
            return T.StringType()
        return T.StructType(
            [T.StructField(f.name, _plain(f.dataType, keep_objects)) for f in data_type.fields]
        )
    return data_type


def infer_schema(df: DataFrame, value: str = "value", keep_objects: bool = False) -> T.StructType:
    """Schema of the JSON objects in a text column.

    Integers become long, other numbers double, nulls, empty arrays and conflicting types text.
    Nested objects become text holding their JSON unless ``keep_objects``. Text that is no object
    has no say: one list among the messages would otherwise make the merged type a conflict.
    """
    message = F.when(F.ltrim(F.col(value)).startswith("{"), F.try_parse_json(F.col(value)))
    return schema_of_shape(df.agg(F.schema_of_variant_agg(message)).first()[0], keep_objects)


def schema_of_shape(found: str | None, keep_objects: bool = False) -> T.StructType:
    """The schema for what ``schema_of_variant_agg`` found."""
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    parsed = T.DataType.fromDDL(_to_ddl(found))
    return T.StructType(
        [T.StructField(f.name, _plain(f.dataType, keep_objects)) for f in parsed.fields]
    )


def parsed_shape(found: str | None) -> T.DataType | None:
    """The type that ``schema_of_variant_agg`` found, as it is; None for no values."""
    return T.DataType.fromDDL(_to_ddl(found)) if found else None


def nested_paths(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
    """Every leaf of a nested schema as a dotted path; an array counts as its element."""
    leaves: list[tuple[str, T.DataType]] = []
    for field in schema.fields:
        path = f"{prefix}.{field.name}" if prefix else field.name
        data_type = field.dataType
        while isinstance(data_type, T.ArrayType):
            data_type = data_type.elementType
        if isinstance(data_type, T.StructType):
            leaves.extend(nested_paths(data_type, path))
        else:
            leaves.append((path, data_type))
    return leaves
