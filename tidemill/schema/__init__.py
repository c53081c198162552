"""Schemas: fixed by configuration, inferred from data, and evolving over time."""

from .evolve import SchemaMismatch, check_strict, conform, conform_and_union, merge_schemas, promote, schema_evolution
from .infer import infer_schema, nested_paths
from .spec import schema_from_config

__all__ = [
    "SchemaMismatch",
    "check_strict",
    "conform",
    "conform_and_union",
    "infer_schema",
    "merge_schemas",
    "nested_paths",
    "promote",
    "schema_evolution",
    "schema_from_config",
]
