"""Continuous ingest, and draining what is there now."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sinks.landed import LandedTable

Writer = Callable[[DataFrame, str], None]


def trigger_options(every: str | None) -> Mapping:
    """``None`` drains the input and stops; an interval such as ``10 seconds`` runs until stopped."""
    return {"availableNow": True} if every is None else {"processingTime": every}


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query that a micro-batch belongs to; its checkpoint keeps it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def each_batch(
    stream: DataFrame, write: Writer, checkpoint: str, name: str, every: str | None = None
) -> StreamingQuery:
    """Hand every micro-batch to ``write`` with an id that a replay of the batch repeats.

    Spark records a batch's input before running it, so after a failure the same rows come again
    under the same id; a writer that replaces by id is exactly-once. The id holds the query's own
    (kept in its checkpoint), so a stream that starts anew never replaces an earlier one's loads.
    """

    def run(batch: DataFrame, number: int) -> None:
        write(batch, f"{name}-{query_id(batch)}-{number:012d}")

    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(run)
        .trigger(**trigger_options(every))
        .start()
    )


def to_landed(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    name: str,
    partition_by=(),
    evolve: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Append a stream to a landed table, one load per micro-batch."""

    def write(batch: DataFrame, load_id: str) -> None:
        LandedTable(batch.sparkSession, root, partition_by).append(batch, load_id, evolve)

    return each_batch(stream, write, checkpoint, name, every)


def to_parquet(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Spark's own file sink: append only, exactly-once through its commit log."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(every))
        .start()
    )


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for a draining query; its failure is raised here."""
    query.awaitTermination()
    return query
