"""Parquet globs and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def parquet_scan(spark: SparkSession, pattern: str, view: str | None = None) -> DataFrame:
    """A Parquet glob as a table, e.g. ``s3a://bucket/table/**/*.parquet``.

    ``**`` reads nested folders as plain files. Without it Spark's partition discovery applies,
    so a root laid out as ``column=value`` folders keeps its partition columns and pruning.
    """
    if "/**/" in pattern:
        root, files = pattern.split("/**/", 1)
        df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", files).parquet(root)
    else:
        df = spark.read.parquet(pattern)
    if view:
        df.createOrReplaceTempView(view)
    return df


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet root if the name is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def parquet_stream(
    spark: SparkSession, pattern: str, files_per_batch: int | None = None, schema=None
) -> DataFrame:
    """Parquet files as a stream: each trigger takes the files that are new.

    Globs only, since a stream over a single named file is refused by Spark.
    """
    reader = spark.readStream.schema(schema if schema is not None else spark.read.parquet(pattern).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(pattern)
