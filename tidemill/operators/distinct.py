"""Exact distinct counts that fold: numbered values, and a bitmap of them per load."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .ranking import number_rows

_VALUES = "place INT, value STRING, number BIGINT"
_BITMAPS = "place INT, bucket BIGINT, bits BINARY, load_id STRING"
# The place of a load's own row, which is there even if the load has no values.
_LOADED = -1


def _as_text(column: Column, kind: T.DataType) -> Column:
    """Text that is equal for equal values of a column and for no others."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        raise ValueError(f"distinct counts need plain values, not {kind.simpleString()}")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (column + F.lit(0).cast(kind)).cast("string")  # -0.0 is 0.0
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")  # local times come twice when clocks go back
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    return column.cast("string")


class DistinctCounts:
    """Distinct values of some columns, counted exactly over any loads without reading these again.

    A value of a column gets a number the first time it is seen, and keeps it. A load leaves a bitmap
    for each 32,768 numbers it reaches (4 KB, however many values it has there), and counts are the
    bits of the bitmaps' union: several columns are counted in one pass without a copy of each row
    per column. NULL is no value, as in ``COUNT(DISTINCT ...)``.

    A load that is added again replaces itself. Numbers are only ever added, in one written job, so
    a job that died leaves at most values that no bitmap names. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str]):
        self.spark, self.path, self.columns = spark, path.rstrip("/"), tuple(columns)
        if len(set(self.columns)) != len(self.columns):
            raise ValueError("a column is named twice")

    def _read(self, part: str, schema: str) -> DataFrame:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")

    def add(self, rows: DataFrame, load_id: str) -> None:
        """Take in a load. ``rows`` is read once per column, and only that column of it."""
        kinds = {f.name: f.dataType for f in rows.schema.fields}
        parts = [
            rows.select(F.lit(i).alias("place"), _as_text(F.col(f"`{name}`"), kinds[name]).alias("value"))
            .filter(F.col("value").isNotNull())
            .distinct()
            for i, name in enumerate(self.columns)
        ]
        seen = self._written(reduce(DataFrame.unionAll, parts), "distinct-seen")
        known = self._read("values", _VALUES)
        new = seen.join(known, ["place", "value"], "left_anti")
        last = known.groupBy("place").agg(F.max("number").alias("last"))  # a row per column
        numbered = number_rows(new, ["place"], ["value"], "place_number").join(F.broadcast(last), "place", "left")
        number = F.col("place_number") + F.coalesce("last", F.lit(0))
        # Written apart first: what is appended to must not be read by the same job.
        fresh = self._written(numbered.select("place", "value", number.alias("number")), "distinct-new")
        if not fresh.isEmpty():
            fresh.write.mode("append").parquet(f"{self.path}/values")
        bitmaps = (
            seen.join(self._read("values", _VALUES), ["place", "value"])
            .groupBy("place", F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
        )
        mark = self.spark.range(1).select(
            F.lit(_LOADED).alias("place"), F.lit(0).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("bits")
        )
        bitmaps.unionByName(mark).withColumn("load_id", F.lit(load_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("load_id").parquet(f"{self.path}/bitmaps")

    def _written(self, rows: DataFrame, label: str) -> DataFrame:
        place = scratch_path(self.spark, label)
        rows.write.parquet(place)
        return self.spark.read.schema(rows.schema).parquet(place)

    def counts(self, loads: Sequence[str] | None = None) -> DataFrame:
        """(name, distinct_values) over all loads, or over those named."""
        found = self._read("bitmaps", _BITMAPS)
        if loads is not None:
            found = found.filter(F.col("load_id").isin(*loads))
        return self._named(_counted(found, []))

    def counts_by_load(self) -> DataFrame:
        """(load_id, name, distinct_values) of each load by itself."""
        found = self._read("bitmaps", _BITMAPS)
        each = found.filter(F.col("place") == _LOADED).select("load_id")
        return self._named(_counted(found, ["load_id"]), each)

    def _named(self, counted: DataFrame, groups: DataFrame | None = None) -> DataFrame:
        """Counts under their columns' names, 0 for a column without values."""
        names = self.spark.createDataFrame(list(enumerate(self.columns)), "place INT, name STRING")
        keys = [] if groups is None else groups.columns
        wanted = names
        if groups is not None:
            wanted = groups.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(len(self.columns) - 1))))
            wanted = wanted.join(F.broadcast(names), "place")
        joined = wanted.join(counted, [*keys, "place"], "left")
        return joined.select(*keys, "name", F.coalesce("n", F.lit(0).cast("bigint")).alias("distinct_values"))


def _counted(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    united = (
        bitmaps.filter(F.col("place") != _LOADED)
        .groupBy(*keys, "place", "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("bits"))
    )
    return united.groupBy(*keys, "place").agg(F.sum("bits").alias("n"))
