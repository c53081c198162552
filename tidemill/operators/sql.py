"""SQL text over a frame."""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_VIEW = threading.RLock()


def sql_transform(df: DataFrame, query: str, view: str = "input_data") -> DataFrame:
    """Run ``query`` with the frame visible as ``input_data``; the result has the query's schema.

    The view is resolved while the query is analysed, so it is dropped again at once and steps
    that run one after the other never see each other's input; a view of that name which the caller
    has is put back. Streams stay streams.
    """
    spark = df.sparkSession
    with _VIEW:
        own = _temp_view(spark, view)
        df.createOrReplaceTempView(view)
        try:
            return spark.sql(query)
        finally:
            if own is None:
                spark.catalog.dropTempView(view)
            else:
                own.createOrReplaceTempView(view)


def _temp_view(spark: SparkSession, view: str) -> DataFrame | None:
    """The session's temporary view of a name, if there is one (a table of that name is none)."""
    try:
        found = spark.catalog.getTable(view)
    except AnalysisException:
        return None
    return spark.table(view) if found.isTemporary else None
