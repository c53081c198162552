"""Schemas given as configuration: ``{"fields": [{"name", "data_type", "nullable"}]}``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

# Type names a configuration may use; anything else is text.
TYPE_NAMES = {
    "int64": T.LongType(),
    "float64": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
}


def schema_from_config(config: Mapping) -> T.StructType:
    """The declared schema. Spark readers relax nullability, so a field with ``nullable: false``
    is enforced by :func:`tidemill.operators.quality.required_rules`, not by the reader."""
    return T.StructType(
        [
            T.StructField(
                f["name"],
                TYPE_NAMES.get(f.get("data_type", "string"), T.StringType()),
                bool(f.get("nullable", False)),
            )
            for f in config.get("fields", [])
        ]
    )


def infers(config: Mapping | None) -> bool:
    """Whether the source infers its schema: yes without a block, opt-in once a block exists."""
    return True if config is None else bool(config.get("auto_infer", False))
