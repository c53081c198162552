"""Content routing: one input, several filtered outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route(df: DataFrame, branches: Mapping[str, Column | str]) -> dict[str, DataFrame]:
    """One frame per branch. Each is a plain filter, so it reaches the scan of a file source."""
    return {
        name: df.filter(F.expr(condition) if isinstance(condition, str) else condition)
        for name, condition in branches.items()
    }


def tagged(branches: Mapping[str, Column | str], tag: str = "branch"):
    """A function that labels rows with every branch they belong to, reading the input once."""
    conditions = {n: F.expr(c) if isinstance(c, str) else c for n, c in branches.items()}

    def apply(df: DataFrame) -> DataFrame:
        names = F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()])
        return df.withColumn(tag, F.explode(F.array_compact(names)))

    return apply
