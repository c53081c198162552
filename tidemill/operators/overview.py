"""What is in a table: schema, size, sample, state."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def describe(df: DataFrame) -> DataFrame:
    """``DESCRIBE QUERY`` of the frame."""
    return df.sparkSession.sql("DESCRIBE QUERY SELECT * FROM {data}", data=df)


def overview(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table (name, count, status, first five columns), as one distributed query."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"),
            "record_count",
            F.when(F.col("record_count") == 0, "empty").otherwise("active").alias("status"),
            F.lit(", ".join(df.columns[:5])).alias("sample_columns"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)
