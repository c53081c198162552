"""Data quality: completeness, profiles and validation rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: position, name, type, records and non-null records, in a single pass."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)],
    )
    described = [
        F.struct(
            F.lit(i + 1).cast("bigint").alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.col("total").alias("total_records"),
            F.col(f"c{i}").alias("non_null_records"),
        )
        for i, f in enumerate(fields)
    ]
    return counted.select(F.inline(F.array(*described)))


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of non-null values per column in percent, with two decimals; NULL on no rows."""
    share = F.try_divide(F.col("non_null_records") * F.lit(100.0), F.col("total_records"))
    return profile(df, columns).select(
        "column_name",
        "total_records",
        "non_null_records",
        share.cast(T.DecimalType(5, 2)).alias("completeness_pct"),
    )


def required_rules(schema: T.StructType) -> dict[str, Column]:
    """A rule per column declared NOT NULL: readers do not enforce that themselves."""
    return {
        f"{f.name} required": F.col(f"`{f.name}`").isNotNull() for f in schema.fields if not f.nullable
    }


def at_least_rules(columns: Sequence[str], minimum: float = 0.0) -> dict[str, Column]:
    """Range rules: a value below the minimum fails; a missing one is left to a required rule."""
    return {
        f"{c} below {minimum:g}": F.col(c).isNull() | (F.col(c) >= F.lit(minimum)) for c in columns
    }


def check_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``failed_rules``, the names of the rules a row breaks (a NULL outcome breaks a rule)."""
    outcomes = [F.when(F.coalesce(ok, F.lit(False)), None).otherwise(F.lit(n)) for n, ok in rules.items()]
    failed = F.array_compact(F.array(*outcomes)) if outcomes else F.array().cast("array<string>")
    return df.withColumn("failed_rules", failed)


def validate(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with the names of the rules they break."""
    checked = check_rules(df, rules)
    good = F.size("failed_rules") == 0
    return checked.filter(good).drop("failed_rules"), checked.filter(~good)
