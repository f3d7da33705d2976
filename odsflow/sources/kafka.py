"""Message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_lines(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """A topic as text lines with their position. `starting` counts for the first start only; later
    the checkpoint keeps the offsets. Needs the public Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")
