"""Reports across the flights, retail and tracks tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quality import completeness

# Names and descriptions in the size report, and the indicator names.
DESCRIPTIONS = {
    "flights": "Flight operations data",
    "retail": "E-commerce product data",
    "spotify": "Music audio features data",
}
ON_TIME, RATING, HIGH_ENERGY = (
    "Flight On-Time Performance",
    "Average Product Rating",
    "High Energy Music Percentage",
)


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def dataset_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table. A bare count of a Parquet table reads only its footers."""
    return _all(
        [
            df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("dataset"), "record_count")
            for name, df in tables.items()
        ]
    )


def dataset_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    described = F.coalesce(*[F.when(F.col("dataset") == n, F.lit(d)) for n, d in DESCRIPTIONS.items()])
    return dataset_counts(tables).withColumn("description", described).orderBy(F.desc("record_count"), "dataset")


def _percent(hits: Column) -> Column:
    return F.try_divide(F.count_if(hits) * F.lit(100.0), F.count(F.lit(1)))


def indicators(flights: DataFrame, retail: DataFrame, tracks: DataFrame) -> DataFrame:
    values = {
        ON_TIME: flights.agg(_percent(F.col("dep_delay") <= 0).alias("v")),
        RATING: retail.agg(F.avg(F.col("rating_text").try_cast("double")).alias("v")),
        HIGH_ENERGY: tracks.agg(_percent(F.col("energy_category") == "high_energy").alias("v")),
    }
    return _all(
        [
            df.select(F.lit(name).alias("metric"), F.col("v").cast("decimal(5,2)").alias("value_pct"))
            for name, df in values.items()
        ]
    )


def completeness_report(columns: Mapping[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    return _all(
        [
            completeness(df.select(*names)).select(F.lit(dataset).alias("dataset"), "*")
            for dataset, (df, names) in columns.items()
        ]
    ).orderBy("dataset", "column_name")


def tagged_sample(name: str, df: DataFrame, order: list[str], rows: int = 3) -> DataFrame:
    """A few rows with the name of their table in front; ordered by key, so repeatable."""
    return df.select(F.lit(name).alias("source"), "*").orderBy(*order).limit(rows)
