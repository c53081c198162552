"""Reports over audio features (danceability, energy, valence, tempo, duration_ms, key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import at_least, below

# Report labels and their limits.
MOODS = ((0.7, "Very Positive"), (0.5, "Positive"), (0.3, "Neutral"))
ENERGIES = ((0.7, "High Energy"), (0.4, "Medium Energy"))
DANCES = ((0.7, "Highly Danceable"), (0.5, "Danceable"))
TEMPOS = ((80, "Slow (<80 BPM)"), (120, "Medium (80-120 BPM)"), (160, "Fast (120-160 BPM)"))
FASTEST = "Very Fast (>160 BPM)"
DURATIONS = ((120000, "Short (<2min)"), (240000, "Medium (2-4min)"), (360000, "Long (4-6min)"))
LONGEST = "Very Long (>6min)"


def _means(**names: str) -> list[Column]:
    return [F.avg(column).alias(name) for name, column in names.items()]


def track_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_tracks"),
        *_means(avg_danceability="danceability", avg_energy="energy", avg_valence="valence", avg_tempo="tempo"),
        F.min("duration_ms").alias("shortest_track_ms"),
        F.max("duration_ms").alias("longest_track_ms"),
    )


def _by_bucket(df: DataFrame, name: str, bucket: Column, order: Column, count: str, means: list[Column]) -> DataFrame:
    """One row per bucket, in an order that the result does not show."""
    return (
        df.groupBy(bucket.alias(name))
        .agg(F.count(F.lit(1)).alias(count), *means, order.alias("_order"))
        .orderBy("_order")
        .drop("_order")
    )


def moods(df: DataFrame) -> DataFrame:
    means = _means(avg_energy="energy", avg_danceability="danceability", avg_tempo="tempo")
    bucket = at_least(F.col("valence"), MOODS, "Negative")
    return _by_bucket(df, "mood", bucket, -F.min("valence"), "track_count", means)


def energy_and_dance(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(
            at_least(F.col("energy"), ENERGIES, "Low Energy").alias("energy_level"),
            at_least(F.col("danceability"), DANCES, "Not Danceable").alias("dance_level"),
        )
        .agg(F.count(F.lit(1)).alias("tracks"), *_means(avg_tempo="tempo", avg_positivity="valence"))
        .orderBy("energy_level", "dance_level")
    )


def tempos(df: DataFrame) -> DataFrame:
    means = _means(avg_energy="energy", avg_danceability="danceability")
    return _by_bucket(df, "tempo_range", below(F.col("tempo"), TEMPOS, FASTEST), F.min("tempo"), "tracks", means)


def musical_keys(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.col("key").alias("musical_key"))
        .agg(F.count(F.lit(1)).alias("tracks"), *_means(avg_positivity="valence", avg_energy="energy"))
        .orderBy(F.desc("tracks"), "musical_key")
    )


def durations(df: DataFrame) -> DataFrame:
    means = _means(avg_energy="energy", avg_danceability="danceability", avg_valence="valence")
    bucket = below(F.col("duration_ms"), DURATIONS, LONGEST)
    return _by_bucket(df, "duration_category", bucket, F.min("duration_ms"), "tracks", means)


def category_mix(df: DataFrame) -> DataFrame:
    keys = ("danceability_category", "energy_category", "mood_category")
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("track_count"),
            *_means(avg_tempo="tempo", avg_duration_seconds="duration_seconds"),
        )
        .orderBy(F.desc("track_count"), *keys)
    )


def tempo_categories(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("tempo_category")
        .agg(
            *_means(avg_energy="energy", avg_danceability="danceability", avg_positivity="valence"),
            F.count(F.lit(1)).alias("track_count"),
        )
        .orderBy(F.desc("avg_energy"))
    )
