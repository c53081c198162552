"""Windows of a number of micro-batches.

The batches of a window are kept in a buffer, a folder with the rows of each batch and a ledger with an
entry for each of the last two: the batches of its window so far, and whether the window is closed. A batch
only looks at the entry before its own, so a restart goes on inside the window, and a replayed batch
replaces its own rows and entry. A window is named by its first batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import remove
from ..sinks.landed import read_log
from .ingest import Writer, query_id, trigger_options

_ENTRY = "batch BIGINT, batches ARRAY<BIGINT>, closed BOOLEAN"


class BatchBuffer:
    """The open window of one streaming query, under ``root``."""

    def __init__(self, spark: SparkSession, root: str, size: int):
        if size < 1:
            raise ValueError("a window has at least one batch")
        self.spark, self.root, self.size = spark, root.rstrip("/"), size

    def _entries(self) -> list:
        """The ledger, newest first; it has three entries at most."""
        return read_log(self.spark, f"{self.root}/ledger", _ENTRY).orderBy(F.desc("batch")).collect()

    def _note(self, batches: list[int], closed: bool) -> None:
        row = self.spark.createDataFrame([(batches[-1], batches, closed)], _ENTRY)
        row.coalesce(1).write.mode("overwrite").json(f"{self.root}/ledger/number={batches[-1]}")

    def _rows(self, batches: list[int]) -> DataFrame:
        """The rows of some batches, united by column name."""
        kept = [self.spark.read.parquet(f"{self.root}/rows/number={n}") for n in batches]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept)

    def add(self, rows: DataFrame, number: int, close: bool = False) -> tuple[int, DataFrame] | None:
        """Keep a batch; (first batch, rows of the window) if it fills the window, or is told to ``close`` it.

        The window counts as closed once :meth:`done` was called for this batch: until then a replay
        gives the same window again. Batches that are not added, since they are empty, don't count.
        """
        earlier = [x for x in self._entries() if x["batch"] < number]
        before = earlier[0] if earlier else None
        batches = [number] if before is None or before["closed"] else [*before["batches"], number]
        if before is not None and before["closed"]:
            for n in before["batches"]:
                remove(self.spark, f"{self.root}/rows/number={n}")
        for entry in earlier[1:]:
            remove(self.spark, f"{self.root}/ledger/number={entry['batch']}")
        rows.write.mode("overwrite").parquet(f"{self.root}/rows/number={number}")
        self._note(batches, False)
        if not close and len(batches) < self.size:
            return None
        return batches[0], self._rows(batches)

    def done(self, number: int) -> None:
        """Close the window that the batch is the last of."""
        for entry in self._entries():
            if entry["batch"] == number:
                self._note(entry["batches"], True)

    def open_window(self) -> tuple[int, int, DataFrame] | None:
        """(first batch, last batch, rows) of a window that is not closed; none if there is none."""
        entries = self._entries()
        if not entries or entries[0]["closed"]:
            return None
        batches = entries[0]["batches"]
        return batches[0], batches[-1], self._rows(batches)


def each_window(
    stream: DataFrame,
    write: Writer,
    checkpoint: str,
    name: str,
    size: int,
    closes: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Hand the rows of every ``size`` micro-batches to ``write`` with an id that names the window.

    A batch with a row for which ``closes`` holds, a mark in the stream, ends its window early. What
    is left after a drain is handed on by :func:`close_window`. Ids repeat if a window is handed on
    again after a failure, so a writer that replaces by id sees each batch exactly once.
    """

    def run(batch: DataFrame, number: int) -> None:
        buffer = BatchBuffer(batch.sparkSession, f"{checkpoint}/windows", size)
        marked = closes is not None and not batch.filter(closes).isEmpty()
        if (full := buffer.add(batch, number, marked)) is not None:
            write(full[1], f"{name}-{query_id(batch)}-window-{full[0]:012d}")
            buffer.done(number)

    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(run)
        .trigger(**trigger_options(every))
        .start()
    )


def close_window(query: StreamingQuery, spark: SparkSession, write: Writer, checkpoint: str, name: str, size: int) -> None:
    """Wait for a draining query of :func:`each_window` and hand on what its last window has."""
    query.awaitTermination()
    buffer = BatchBuffer(spark, f"{checkpoint}/windows", size)
    if (rest := buffer.open_window()) is not None:
        first, last, rows = rest
        write(rows, f"{name}-{query.id}-window-{first:012d}")
        buffer.done(last)
