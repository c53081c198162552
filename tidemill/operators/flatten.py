"""Flattening of nested data, into columns or into one flat JSON text.

Depth counts from the row: the row itself is 0, its columns 1, and both an object key and the
step into an array add one. What lies deeper than ``max_depth`` is left out, and of an array only
the first element is kept.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema.infer import parsed_shape


def _leaves(column: Column, data_type: T.DataType, path: str, depth: int, sep: str, limit: int):
    if depth > limit:
        return
    if isinstance(data_type, T.StructType):
        for field in data_type.fields:
            yield from _leaves(
                column.getField(field.name), field.dataType, f"{path}{sep}{field.name}", depth + 1, sep, limit
            )
    elif isinstance(data_type, T.ArrayType):
        yield from _leaves(F.get(column, F.lit(0)), data_type.elementType, path, depth + 1, sep, limit)
    elif isinstance(data_type, T.MapType):
        yield path, F.to_json(column)
    else:
        yield path, column


def flatten_columns(df: DataFrame, separator: str = "_", max_depth: int = 5) -> DataFrame:
    """One column per leaf of the nested columns. Maps have no fixed keys and become JSON text."""
    found = [
        leaf
        for field in df.schema.fields
        for leaf in _leaves(F.col(f"`{field.name}`"), field.dataType, field.name, 1, separator, max_depth)
    ]
    names = [path.lower() for path, _ in found]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"flattened names collide: {', '.join(twice)}; choose another separator")
    return df.select(*[column.alias(path) for path, column in found])


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: lambda variables are bound, columns are not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _entry(path: Column, value: Column) -> Column:
    """A path with its value, and the value's keys or first item where it has any.

    The first item is looked up in the binary value: a long array is never unpacked.
    """
    return F.struct(
        path.alias("path"),
        value.alias("value"),
        value.try_cast("map<string,variant>").alias("keys"),
        F.try_variant_get(value, "$[0]", "variant").alias("head"),
    )


def _is_nested(entry: Column) -> Column:
    """Objects, and arrays with items. Scalars and empty arrays are leaves."""
    return entry["keys"].isNotNull() | entry["head"].isNotNull()


def _children(entry: Column, separator: str) -> Column:
    """The keys of an object, the head of an array, or the entry itself."""
    path = entry["path"]

    def child(pair: Column) -> Column:
        name = F.when(path == "", pair["key"]).otherwise(F.concat(path, F.lit(separator), pair["key"]))
        return _entry(name, pair["value"])

    return (
        F.when(entry["keys"].isNotNull(), F.transform(F.map_entries(entry["keys"]), child))
        .when(entry["head"].isNotNull(), F.array(_entry(path, entry["head"])))
        .otherwise(F.array(entry))
    )


def _one_level(entries: Column, separator: str) -> Column:
    """Open what is nested; rows that are flat already are passed on as they are."""
    return _with(
        entries,
        lambda some: F.when(
            F.exists(some, _is_nested), F.flatten(F.transform(some, lambda e: _children(e, separator)))
        ).otherwise(some),
    )


def _last_of_each(entries: Column) -> Column:
    """Entries without those whose path comes again later."""

    def unique(bound: Column) -> Column:
        return _with(
            F.transform(bound, lambda e: e["path"]),
            lambda names: F.when(F.size(F.array_distinct(names)) == F.size(names), bound).otherwise(
                F.filter(
                    bound,
                    lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["path"]),
                )
            ),
        )

    return _with(entries, unique)


def flatten_text(value: Column, separator: str = "_", max_depth: int = 5) -> Column:
    """A VARIANT as flat JSON text, NULLs and empty arrays kept; of equal names the last wins."""

    def flat(root: Column) -> Column:
        entries = F.array(_entry(F.lit(""), root))
        for _ in range(max_depth):
            entries = _one_level(entries, separator)
        leaves = F.transform(
            F.filter(entries, lambda e: ~_is_nested(e)),
            lambda e: F.struct(e["path"].alias("path"), e["value"].alias("value")),
        )
        text = F.to_json(F.map_from_entries(_last_of_each(leaves)), {"ignoreNullFields": "false"})
        return F.when(root.isNotNull(), text)

    return _with(value, flat)


class _NoFixedPaths(Exception):
    """The shape has names that a path or a struct cannot hold."""


def _fixed(value: Column, shape: T.DataType, path: str, name: str, depth: int, sep: str, limit: int):
    """A node's own value where it is a leaf, the (name, value) of leaves below it, and tests for odd rows.

    A node that holds objects in some rows is a leaf in those where it is null; one that holds arrays
    also where they are empty. A row is odd if it has something nested where others have a scalar.
    """
    if depth > limit:
        return None, [], []
    here = F.try_variant_get(value, path, "variant")
    if isinstance(shape, T.StructType):
        below, odd = [], []
        for field in sorted(shape.fields, key=lambda f: f.name.encode("utf-16-be")):  # the order of keys in a VARIANT
            if not re.fullmatch(r"[^'?]+", field.name):
                raise _NoFixedPaths
            full = f"{name}{sep}{field.name}" if depth else field.name
            own, more, tests = _fixed(value, field.dataType, f"{path}['{field.name}']", full, depth + 1, sep, limit)
            below += ([] if own is None else [(full, own)]) + more
            odd += tests
        return F.when(F.is_variant_null(here), here), below, odd
    head = F.try_variant_get(value, f"{path}[0]", "variant")
    if isinstance(shape, T.ArrayType):
        own, below, odd = _fixed(value, shape.elementType, f"{path}[0]", name, depth + 1, sep, limit)
        empty = F.when(head.isNull(), here)
        return (empty if own is None else F.coalesce(own, empty)), below, odd
    if isinstance(shape, T.VariantType):
        keys = F.try_variant_get(value, path, "map<string,variant>")
        return here, [], [head.isNotNull() | keys.isNotNull()]
    return here, [], []


def _by_shape(value: Column, shape: T.DataType | None, separator: str, max_depth: int) -> Column | None:
    """What :func:`flatten_text` gives, by fixed paths that are compiled; None if the shape does not allow it."""
    if not isinstance(shape, T.StructType):
        return None
    try:
        _, leaves, odd = _fixed(value, shape, "$", "", 0, separator, max_depth)
    except _NoFixedPaths:
        return None
    names = [name for name, _ in leaves]
    if len(set(names)) != len(names):  # the last of equal names wins, row by row
        return None
    fields = [leaf.alias(name) for name, leaf in leaves]
    # A missing key is a NULL and left out; a null in the JSON text is a value and stays.
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}) if fields else F.lit("{}")
    flat = F.when(value.isNull(), F.lit(None)).when(F.is_variant_null(value), F.lit('{"":null}'))
    for test in odd:
        flat = flat.when(test, flatten_text(value, separator, max_depth))
    return flat.otherwise(text)


def json_flatten(
    df: DataFrame,
    separator: str = "_",
    max_depth: int = 5,
    value: str | None = None,
    by_shape: bool = False,
) -> DataFrame:
    """Flatten into columns; or, given a JSON text column, into one ``flattened_data`` column.

    With ``by_shape``, the merged shape of all messages is found first, by one more pass over them, and
    its paths are then read by compiled code, which gives the same text. A row that is nested where the
    others are not is flattened the general way, as are all rows if flat names collide. It pays for
    messages that mostly have the same keys: each row looks up all paths of the shape. Streams have
    no such pass.
    """
    if value is None:
        return flatten_columns(df, separator, max_depth)
    parsed = F.try_parse_json(F.col(value))
    if not by_shape:
        return df.withColumn("flattened_data", flatten_text(parsed, separator, max_depth)).drop(value)
    if df.isStreaming:
        raise ValueError("the shape of a stream is not known beforehand; flatten without by_shape")
    shape = parsed_shape(df.agg(F.schema_of_variant_agg(parsed)).first()[0])
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (value, "flattened_data")]
    rows = df.select(*kept, parsed.alias("flattened_data"))
    message = F.col("flattened_data")
    flat = _by_shape(message, shape, separator, max_depth)
    return rows.withColumn("flattened_data", flatten_text(message, separator, max_depth) if flat is None else flat)


def rows_as_flat_json(df: DataFrame, separator: str = "_", max_depth: int = 5) -> DataFrame:
    """Each whole row as one flat JSON text in ``flattened_data``."""
    row = F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return df.select(flatten_text(row, separator, max_depth).alias("flattened_data"))
