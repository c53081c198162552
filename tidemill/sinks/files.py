"""Console previews, Parquet folders and Kafka frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stdout_pretty(df: DataFrame, rows: int = 20) -> None:
    """Print the first rows as a table; only these reach the driver."""
    df.show(rows, truncate=False)


def stdout_stream(df: DataFrame, checkpoint: str):
    return (
        df.writeStream.format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def parquet_dir(df: DataFrame, sink_id: str, path: str) -> str:
    """Replace ``{path}/{id}.parquet`` by the rows of the frame; returns that path."""
    target = f"{path.rstrip('/')}/{sink_id}.parquet"
    df.write.mode("overwrite").parquet(target)
    return target


def partitioned(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together before a partitioned write, so each folder gets few
    files. The rebalance hint lets AQE split a partition that holds much of the data over several
    tasks; a plain repartition by the columns would send it to a single one."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def partitioned_write(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "append") -> None:
    """Hive layout ``column=value/``, from which later reads prune."""
    partitioned(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def kafka_frame(df: DataFrame, key: Column | None = None) -> DataFrame:
    """Rows as Kafka records: a text key (empty by default) and the row as JSON, NULLs included."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(
        (F.lit("") if key is None else key.cast("string")).alias("key"), row.alias("value")
    )


def kafka_write(df: DataFrame, brokers: str, topic: str, key: Column | None = None) -> None:
    """Send rows as JSON messages; needs the Kafka connector on the classpath."""
    kafka_frame(df, key).write.format("kafka").option("kafka.bootstrap.servers", brokers).option(
        "topic", topic
    ).save()


def kafka_stream_write(df: DataFrame, brokers: str, topic: str, checkpoint: str, key: Column | None = None):
    """The same for a stream: at least once, since the connector does not take part in commits."""
    return (
        kafka_frame(df, key)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
