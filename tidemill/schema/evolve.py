"""Merging schemas and bringing rows to a merged schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type changes that widen a column; every other change keeps the old type.
PROMOTIONS = {
    ("int", "bigint"): T.LongType(),
    ("float", "double"): T.DoubleType(),
    ("int", "double"): T.DoubleType(),
    ("bigint", "double"): T.DoubleType(),
}


class SchemaMismatch(ValueError):
    """Rows do not have the schema a strict step requires."""


def promote(existing: T.DataType, new: T.DataType) -> T.DataType:
    return PROMOTIONS.get((existing.simpleString(), new.simpleString()), existing)


def merge_schemas(existing: T.StructType, new: T.StructType) -> T.StructType:
    """Union by name: existing columns first, in order and widened, then new ones as they came.

    Names compare without case, as Spark resolves them.
    """
    incoming = {f.name.lower(): f for f in new.fields}
    known = {f.name.lower() for f in existing.fields}
    merged = []
    for field in existing.fields:
        other = incoming.get(field.name.lower())
        if other is None:
            merged.append(T.StructField(field.name, field.dataType, True))
        else:
            merged.append(T.StructField(field.name, promote(field.dataType, other.dataType), other.nullable))
    merged.extend(f for f in new.fields if f.name.lower() not in known)
    return T.StructType(merged)


def _as_type(column: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return column
    if isinstance(want, T.StringType) and isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column)
    return column.try_cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select exactly the columns of ``schema``: missing ones NULL, others cast where possible."""
    have = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        source = have.get(field.name.lower())
        if source is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            name = source.name.replace("`", "``")
            columns.append(_as_type(F.col(f"`{name}`"), source.dataType, field.dataType).alias(field.name))
    return df.select(*columns)


def conform_and_union(frames: Sequence[DataFrame]) -> tuple[DataFrame, T.StructType]:
    """Union of frames whose schemas differ, under their merged schema."""
    target = reduce(merge_schemas, [f.schema for f in frames])
    return reduce(DataFrame.unionByName, [conform(f, target) for f in frames]), target


def check_strict(actual: T.StructType, registered: T.StructType) -> None:
    """Raise on any new, removed or retyped column."""
    have = {f.name.lower(): f.dataType for f in actual.fields}
    want = {f.name.lower(): f.dataType for f in registered.fields}
    problems = [f"new column {n}" for n in have if n not in want]
    problems += [f"missing column {n}" for n in want if n not in have]
    problems += [
        f"column {n} is {have[n].simpleString()}, expected {want[n].simpleString()}"
        for n in want
        if n in have and have[n] != want[n]
    ]
    if problems:
        raise SchemaMismatch("; ".join(problems))


def schema_evolution(
    df: DataFrame,
    registered: T.StructType | None = None,
    auto_infer: bool = False,
    strict_mode: bool = False,
) -> DataFrame:
    """Bring rows to the registered schema.

    Strict mode raises on any difference. With ``auto_infer`` the registered schema is first
    widened by what arrived; without it unknown columns are dropped.
    """
    if registered is None:
        return df
    if strict_mode:
        check_strict(df.schema, registered)
    target = merge_schemas(registered, df.schema) if auto_infer else registered
    return conform(df, target)
