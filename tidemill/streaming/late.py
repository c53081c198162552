"""Late rows of a stream, kept apart and counted.

Spark drops rows behind the watermark inside its aggregates. Here a stream is parted before: a row is late
if its time is more than the allowed delay behind the newest time of all earlier batches. What is on time and
what is late goes to a writer each, and a ledger has the newest time and the counts of each batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks.landed import read_log
from .ingest import Writer, query_id, trigger_options

_ENTRY = "batch BIGINT, newest TIMESTAMP_NTZ, rows BIGINT, late BIGINT"


def late_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch, newest, rows, late) of each batch: the newest time so far, the rows, and those that came too late."""
    return read_log(spark, f"{checkpoint}/late", _ENTRY)


def part_late(
    stream: DataFrame,
    time: str,
    late_by: str,
    on_time: Writer,
    late: Writer,
    checkpoint: str,
    name: str,
    every: str | None = None,
) -> StreamingQuery:
    """Hand the rows of each batch that are on time to one writer and the others to another, under one id.

    ``late_by`` is an interval such as ``1 day``. Rows without a time are late. A replayed batch is
    parted in the same way, since it only looks at the batch before it, so writers that replace by id
    see each row exactly once.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = read_log(spark, f"{checkpoint}/late/number={number - 1}", _ENTRY).first()
        newest = before["newest"] if before is not None else None
        batch = batch.persist()
        try:
            when = F.col(f"`{time}`").cast("timestamp_ntz")
            limit = F.lit(newest).cast("timestamp_ntz") - F.expr(f"interval {late_by}")
            behind = when.isNull() | F.coalesce(when < limit, F.lit(False))
            load = f"{name}-{query_id(batch)}-{number:012d}"
            on_time(batch.where(~behind), load)
            late(batch.where(behind), load)
            entry = batch.agg(
                F.lit(number).cast("bigint").alias("batch"),
                F.greatest(F.max(when), F.lit(newest).cast("timestamp_ntz")).alias("newest"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(behind).alias("late"),
            )
            entry.coalesce(1).write.mode("overwrite").json(f"{checkpoint}/late/number={number}")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(run)
        .trigger(**trigger_options(every))
        .start()
    )
