"""Kafka topics as streams of JSON text."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Reader = Callable[[SparkSession, Mapping[str, str]], DataFrame]


def kafka_options(spec: Mapping) -> dict[str, str]:
    """Connector options of a source entry. Offsets live in the checkpoint, not in the group, so a
    restart resumes after the last committed batch and nothing is lost between read and write."""
    options = {
        "kafka.bootstrap.servers": spec["brokers"],
        "subscribe": spec["topic"],
        "groupIdPrefix": spec.get("group_id", "tidemill"),
        "startingOffsets": spec.get("starting_offsets", "earliest"),
        "failOnDataLoss": str(spec.get("fail_on_data_loss", True)).lower(),
    }
    if spec.get("max_offsets_per_trigger"):
        options["maxOffsetsPerTrigger"] = str(spec["max_offsets_per_trigger"])
    return options


def connector(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The Kafka connector; its jar must be on the classpath."""
    return spark.readStream.format("kafka").options(**options).load()


def kafka_stream(spark: SparkSession, spec: Mapping, reader: Reader = connector) -> DataFrame:
    """Messages as one text column ``value``. ``reader`` may be anything with such a column."""
    return reader(spark, kafka_options(spec)).select(F.col("value").cast("string").alias("value"))
