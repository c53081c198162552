"""The loads of a landed table as a feed: each consumer gets every logged load once.

A run's loads are noted before they are handed on and marked done afterwards, under
``{root}/consumers/<name>``. After a failure the same loads come again under the same id, so a writer that
replaces by id sees each load exactly once. A load that is not in the table's log is not handed on, and
one that is replaced after it was, not again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .landed import LandedTable, read_log

_RUNS = "load_id STRING, run BIGINT"


class ChangeFeed:
    def __init__(self, table: LandedTable, consumer: str):
        self.table, self.consumer = table, consumer
        self.place = f"{table.root}/consumers/{consumer}"

    def _runs(self) -> DataFrame:
        spark = self.table.spark
        try:
            return spark.read.schema(_RUNS).parquet(f"{self.place}/runs")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], _RUNS)

    def next(self) -> tuple[int, DataFrame] | None:
        """(run, rows) of the loads logged since the last run that is done; none if there are none."""
        spark = self.table.spark
        runs = self._runs()
        last = runs.agg(F.max("run")).first()[0] or 0
        done = read_log(spark, f"{self.place}/done", "run BIGINT").agg(F.max("run")).first()[0] or 0
        if last == done:
            logged = self.table.loads_logged()
            fresh = logged.join(runs, "load_id", "left_anti")
            if fresh.isEmpty():
                return None
            last += 1
            fresh.write.mode("overwrite").parquet(f"{self.place}/runs/run={last}")
        own = spark.read.schema("load_id STRING").parquet(f"{self.place}/runs/run={last}")
        return last, self.table.read_loads(own)

    def done(self, run: int) -> None:
        row = self.table.spark.range(1).select(F.lit(run).alias("run"))
        row.coalesce(1).write.mode("overwrite").json(f"{self.place}/done")


def each_change(table: LandedTable, consumer: str, write: Callable[[DataFrame, str], None]) -> int:
    """Hand all loads that the consumer has not seen to ``write``, with an id that a replay repeats; how many runs."""
    feed, runs = ChangeFeed(table, consumer), 0
    while (found := feed.next()) is not None:
        run, rows = found
        write(rows, f"{consumer}-{run:012d}")
        feed.done(run)
        runs += 1
    return runs
