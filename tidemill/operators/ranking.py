"""Ordered operators: top-k, latest row, share of total and row numbers within a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_root

def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of an order: each task keeps k rows, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(k)


def latest(df: DataFrame, time: str, tie_break: str) -> DataFrame:
    return top_k(df, 1, F.desc(time), F.desc(tie_break))


def with_share(grouped: DataFrame, count: str, name: str = "percentage") -> DataFrame:
    """Add each group's share of the total in percent.

    The input is grouped already, one row per bucket, so a window over all rows is small.
    """
    total = F.sum(count).over(Window.partitionBy())
    return grouped.withColumn(name, F.round(F.col(count) * F.lit(100.0) / total, 2))


def number_rows(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], name: str) -> DataFrame:
    """``ROW_NUMBER()`` within a key as BIGINT, safe when one key holds a large part of the rows.

    ``order_by`` must end in a unique column. The rows are cut into even ranges of (key, order), as
    many as there are shuffle partitions, numbered within each range, and shifted by the number of
    rows the same key has in earlier ranges. Only the first key of a range can have any, so the
    table of shifts has at most one row per range and can be broadcast.
    """
    keys = list(partition_by)
    order = [F.col(c) for c in order_by]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared_root(df.sparkSession)
    # The range bounds come from a sample: they must not change between the two uses below.
    ranged = (
        df.repartitionByRange(ranges, *keys, *order_by)
        .withColumn("_range", F.spark_partition_id())
        .checkpoint()
    )
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("_range", *keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_shift", F.sum("_rows").over(earlier))
        .filter(F.col("_shift") > 0)
        .select(F.col("_range").alias("_at"), *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_shift")
    )
    local = ranged.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*order))
    )
    same = F.col("_range") == F.col("_at")
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_key{i}"))
    number = F.col("_local").cast("bigint") + F.coalesce("_shift", F.lit(0))
    return local.join(F.broadcast(shifts), same, "left").select(*df.columns, number.alias(name))


def running_totals(df: DataFrame, order_by: Sequence[str], value: str, number: str, total: str) -> DataFrame:
    """Rows numbered from 1 in the order of ``order_by``, which must be unique, with the total of ``value`` so far.

    Even ranges of the order are summed up by themselves and shifted by the ranges before, of which
    there are as many as shuffle partitions.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared_root(df.sparkSession)
    # The range bounds come from a sample: they must not change between the two uses below.
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{value}`").alias("value"),
                    *[F.col(f"`{c}`").alias(f"key{i}") for i, c in enumerate(order_by)])
    keys = [f"key{i}" for i in range(len(order_by))]
    ranged = own.repartitionByRange(ranges, *keys).withColumn("range", F.spark_partition_id()).checkpoint()
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("rows"), F.sum("value").alias("sum"))
    shifts = sums.select(
        "range", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("rows", "sum")]
    )
    local = Window.partitionBy("range").orderBy(*keys)
    so_far = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ranged.withColumn("n", F.row_number().over(local))
        .withColumn("upto", F.coalesce(F.sum("value").over(so_far), F.lit(0)))
        .join(F.broadcast(shifts), "range")
        .select("row.*", (F.col("n") + F.col("rows_before")).alias(number), (F.col("upto") + F.col("sum_before")).alias(total))
    )
