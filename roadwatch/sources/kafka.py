"""Kafka in and out. Needs the Spark Kafka connector on the class path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

PARTITIONS = 1 << 16  # a topic has fewer partitions than this


def source_options(servers: str, topic: str, group: str | None = None, *,
                   start: str = "latest", max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Reader options. The checkpoint keeps the position; ``start`` is for the first run."""
    if start not in ("latest", "earliest"):
        raise ValueError("start is 'latest' or 'earliest'")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if group:
        options["kafka.group.id"] = group
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return lines(spark.readStream.format("kafka").options(**options).load())


def lines(records: DataFrame) -> DataFrame:
    """The record values as text, with partition, offset and a unique ``arrival``.

    Offsets repeat in every partition, so ``arrival`` holds both. Records of one
    key lie in one partition when the producer keys them; their order is the
    offset's. As an order of ``running`` it takes a ``width`` of ``PARTITIONS``
    times the rows per bucket.
    """
    return records.select(F.col("value").cast("string").alias("value"), "partition", "offset",
                          (F.col("offset") * PARTITIONS + F.col("partition")).alias("arrival"))


def sink_options(servers: str, topic: str, batch_bytes: int = 16384,
                 buffer_bytes: int = 33554432) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers, "topic": topic,
        "kafka.batch.size": str(batch_bytes), "kafka.buffer.memory": str(buffer_bytes),
    }


def as_lines(df: DataFrame, columns: Sequence[str], sep: str = "\t") -> DataFrame:
    """One text record per row. A null is an empty field, so positions hold."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def write_stream(values: DataFrame, options: dict[str, str], checkpoint: str) -> DataStreamWriter:
    return (values.writeStream.format("kafka").options(**options)
            .option("checkpointLocation", checkpoint))
