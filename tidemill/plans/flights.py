"""Reports over a flights table (fl_date, dep_delay, arr_delay, distance, air_time)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import at_most, below, first_match
from ..operators.ranking import top_k, with_share

# Report labels and their limits.
DISTANCES = ((500, "Short (<500mi)"), (1000, "Medium (500-1000mi)"), (2000, "Long (1000-2000mi)"))
FARTHEST = "Very Long (>2000mi)"
DEPARTURES = ((0, "On Time"), (15, "Minor Delay"), (60, "Moderate Delay"))
WORST_DEPARTURE = "Major Delay"
LATE_MINUTES = 15


def _late(column: str) -> Column:
    return F.count_if(F.col(column) > LATE_MINUTES)


def performance(dep: Column, arr: Column) -> Column:
    cases = [
        ((dep <= 0) & (arr <= 0), "Early"),
        (dep.between(0, LATE_MINUTES) & arr.between(0, LATE_MINUTES), "On Time"),
        ((dep > LATE_MINUTES) | (arr > LATE_MINUTES), "Delayed"),
    ]
    return first_match(cases, "Unknown")


def date_range(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.min("fl_date").alias("earliest_date"),
        F.max("fl_date").alias("latest_date"),
    )


def delays_by_day(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("fl_date")
        .agg(
            F.count(F.lit(1)).alias("flights_count"),
            F.avg("dep_delay").alias("avg_departure_delay"),
            F.avg("arr_delay").alias("avg_arrival_delay"),
            _late("dep_delay").alias("delayed_departures"),
            _late("arr_delay").alias("delayed_arrivals"),
        )
        .orderBy("fl_date")
    )


def performance_share(df: DataFrame) -> DataFrame:
    label = performance(F.col("dep_delay"), F.col("arr_delay"))
    grouped = df.groupBy(label.alias("performance_category")).agg(F.count(F.lit(1)).alias("flight_count"))
    return with_share(grouped, "flight_count").orderBy(F.desc("flight_count"))


def delays_by_distance(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(below(F.col("distance"), DISTANCES, FARTHEST).alias("distance_category"))
        .agg(
            F.count(F.lit(1)).alias("flights"),
            F.avg("dep_delay").alias("avg_dep_delay"),
            F.avg("arr_delay").alias("avg_arr_delay"),
            F.avg("air_time").alias("avg_air_time"),
        )
        .orderBy("distance_category")
    )


def worst_days(df: DataFrame, days: int = 10) -> DataFrame:
    grouped = (
        df.filter((F.col("dep_delay") > 0) | (F.col("arr_delay") > 0))
        .groupBy("fl_date")
        .agg(
            F.avg(F.col("dep_delay") + F.col("arr_delay")).alias("total_avg_delay"),
            F.max("dep_delay").alias("max_departure_delay"),
            F.max("arr_delay").alias("max_arrival_delay"),
            F.count(F.lit(1)).alias("flights_count"),
        )
    )
    return top_k(grouped, days, F.desc_nulls_last("total_avg_delay"), F.col("fl_date"))


def delay_totals_by_day(df: DataFrame) -> DataFrame:
    """Like :func:`delays_by_day`, with the late flights summed: NULL, not 0, where no row exists."""
    late = {
        name: F.sum(F.when(F.col(column) > LATE_MINUTES, 1).otherwise(0))
        for name, column in (("delayed_departures", "dep_delay"), ("delayed_arrivals", "arr_delay"))
    }
    return (
        df.groupBy("fl_date")
        .agg(
            F.avg("dep_delay").alias("avg_departure_delay"),
            F.avg("arr_delay").alias("avg_arrival_delay"),
            F.count(F.lit(1)).alias("total_flights"),
            *[column.alias(name) for name, column in late.items()],
        )
        .orderBy("fl_date")
    )


def arrival_by_departure(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(at_most(F.col("dep_delay"), DEPARTURES, WORST_DEPARTURE).alias("departure_category"))
        .agg(F.avg("arr_delay").alias("avg_arrival_delay"), F.count(F.lit(1)).alias("flight_count"))
        .orderBy("avg_arrival_delay")
    )
