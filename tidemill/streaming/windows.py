"""Time-window aggregates over a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .ingest import query_id, trigger_options


def with_event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a TIMESTAMP: values stored without a zone are taken as UTC session time. A column
    that is one already stays as it is, with the watermark it may have."""
    if df.schema[column].dataType == T.TimestampType():
        return df
    return df.withColumn(column, F.col(column).cast("timestamp"))


def window_stats(
    df: DataFrame,
    time: str,
    value: str,
    width: str,
    keys: Sequence[str] = (),
    late_by: str | None = None,
) -> DataFrame:
    """Count, mean, minimum and maximum of a value per tumbling window and key.

    Works on streams and on tables alike. ``late_by`` sets the watermark of a stream: rows older
    than it are dropped here, and state of closed windows is released. Aggregates are combined
    before the shuffle, so a key with many rows sends one row per task and window.
    """
    timed = with_event_time(df, time)
    if late_by is not None and df.isStreaming:
        timed = timed.withWatermark(time, late_by)
    return (
        timed.groupBy(F.window(time, width).alias("w"), *keys)
        .agg(
            F.count(F.lit(1)).alias("data_points"),
            F.avg(value).alias("avg_value"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
        )
        .select(F.col("w.start").alias("window_start"), *keys, "data_points", "avg_value", "min_value", "max_value")
    )


WATERMARK_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def joint_window_stats(
    streams: Mapping[str, DataFrame],
    time: str,
    value: str,
    width: str,
    late_by: str,
    keys: Sequence[str] = (),
    wait_for_idle: bool = True,
) -> DataFrame:
    """``window_stats`` over several sources as one stream, with a column ``source``.

    Each source has a watermark of its own, and theirs is the least: a window is closed once all sources
    have passed it, so a slow source loses no rows to a fast one. A source that sends nothing holds
    all windows open; with ``wait_for_idle`` off the fastest source decides, and rows of slower
    ones that come behind it are late. The choice is kept in the query's checkpoint.
    """
    parts = []
    for name, stream in streams.items():
        timed = with_event_time(stream, time).withWatermark(time, late_by)
        parts.append(timed.select(F.lit(name).alias("source"), time, value, *keys))
        stream.sparkSession.conf.set(WATERMARK_POLICY, "min" if wait_for_idle else "max")
    return window_stats(reduce(DataFrame.unionByName, parts), time, value, width, ["source", *keys])


def to_updates(
    aggregate: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write each batch's changed windows to ``{path}/query_id=<id>/batch_id=<n>``, replaced on a replay.

    Unlike append mode this also shows windows that are still open when the stream is drained. A
    stream that starts anew writes under its own id, and its rows are newer by ``written_at``.
    """

    def run(batch: DataFrame, number: int) -> None:
        timed = batch.withColumn("written_at", F.current_timestamp())
        timed.write.mode("overwrite").parquet(f"{path}/query_id={query_id(batch)}/batch_id={number}")

    return (
        aggregate.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(run)
        .trigger(**trigger_options(every))
        .start()
    )


def latest_updates(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row per window and key of a folder written by :func:`to_updates`."""
    order = ("written_at", "batch_id")
    values = [c for c in updates.columns if c not in (*keys, *order, "query_id")]
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("newest")
    return updates.groupBy(*keys).agg(newest).select(*keys, "newest.*")
