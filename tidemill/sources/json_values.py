"""Rows from JSON text, with records that are not JSON objects kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a missing field reads as when defaults are asked for.
DEFAULTS = {
    T.BooleanType: False,
    T.LongType: 0,
    T.DoubleType: 0.0,
    T.StringType: "",
}


def _is_object(value: Column) -> Column:
    """Well-formed JSON whose top level is an object. Only keys are looked at; an object that
    repeats a key is one too, and its last value counts."""
    return F.json_object_keys(value).isNotNull()


def split_json(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Records that are JSON objects, and the others with their text and a reason.

    Rows without any text belong to neither. Both are filters over the same input; persist it
    first if reading it twice costs more than keeping it.
    """
    text = F.col(value)
    present = df.filter(text.isNotNull())
    bad = present.filter(~_is_object(text)).withColumn(
        "reason", F.when(F.try_parse_json(text).isNull(), "malformed").otherwise("not an object")
    )
    return present.filter(_is_object(text)), bad


def parse_json(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    keep: Sequence[str] = (),
    on_missing: str = "null",
) -> DataFrame:
    """Typed columns from JSON objects; other records and undeclared fields are dropped.

    A missing or wrongly typed field is NULL, or with ``on_missing="default"`` false, 0 or "".
    A text field receives a nested object as its JSON.
    """
    if on_missing not in ("null", "default"):
        raise ValueError(f"unknown on_missing mode {on_missing}")
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    good, _ = split_json(df, value)
    parsed = good.select(*keep, F.from_json(F.col(value), nullable).alias("_json"))
    columns = []
    for field in schema.fields:
        column = F.col("_json").getField(field.name)
        default = DEFAULTS.get(type(field.dataType))
        if on_missing == "default" and default is not None:
            column = F.coalesce(column, F.lit(default))
        columns.append(column.alias(field.name))
    return parsed.select(*keep, *columns)
