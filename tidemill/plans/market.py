"""Reports over market prices (timestamp, price, volume_24h, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import latest


def since(column: str, as_of: str, days: int = 0, hours: int = 0) -> Column:
    """Rows of the last days (whole days back from midnight) or hours; pushed down to the scan."""
    moment = F.lit(as_of).cast("timestamp_ntz")
    if days:
        start = F.timestamp_add("DAY", F.lit(-days), F.date_trunc("day", moment).cast("timestamp_ntz"))
    else:
        start = F.timestamp_add("HOUR", F.lit(-hours), moment)
    return F.col(column) >= start


def latest_price(df: DataFrame) -> DataFrame:
    return latest(df, "timestamp", "id").select(
        "timestamp", "price", "volume_24h", "market_cap", "price_change_24h", "market_sentiment"
    )


def daily_trend(df: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    return (
        df.filter(since("timestamp", as_of, days))
        .groupBy(F.to_date("timestamp").alias("date"))
        .agg(
            F.avg("price").alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.count(F.lit(1)).alias("data_points"),
        )
        .orderBy(F.desc("date"))
    )


def price_by_hour(df: DataFrame) -> DataFrame:
    hour = F.hour("timestamp").cast("bigint").alias("hour")
    return df.groupBy(hour).agg(F.avg("price").alias("avg_price")).orderBy("hour")


def daily_volume(df: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    return (
        df.filter(since("timestamp", as_of, days))
        .groupBy(F.to_date("timestamp").alias("date"))
        .agg(
            F.avg("price").alias("avg_price"),
            F.max("price").alias("max_price"),
            F.min("price").alias("min_price"),
            F.sum("volume_24h").alias("total_volume"),
        )
        .orderBy("date")
    )
