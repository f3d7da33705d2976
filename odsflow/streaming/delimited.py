"""Delimited messages, appended as typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from odsflow.functions.text import NAME_AGE, split_fields
from odsflow.sinks.jdbc import jdbc_append, jdbc_execute
from odsflow.streaming.triggers import FLUSH_SECONDS, trigger_options


def parse_lines(lines: DataFrame, delimiter: str = "#", fields: Sequence[tuple[str, str]] = NAME_AGE) -> DataFrame:
    """Adds the declared fields and `rejected` to lines held in `value`; works on batches and streams.

    `fields` lists (name, type) in the order of the message.
    """
    parsed = lines.withColumn("_p", split_fields(F.col("value"), fields, delimiter))
    return parsed.select(
        *lines.columns,
        *[F.when(F.col("_p.ok"), F.col(f"_p.{name}")).alias(name) for name, _ in fields],
        (~F.col("_p.ok")).alias("rejected"),
    )


def append_lines(
    lines: DataFrame, target: str, checkpoint: str, delimiter: str = "#", seconds: int | None = None,
    fields: Sequence[tuple[str, str]] = NAME_AGE,
) -> StreamingQuery:
    """Appends good and rejected lines to one parquet table partitioned by `rejected`.

    Spark's file sink commits each batch once, so a restart neither loses nor doubles lines.
    """
    return (
        parse_lines(lines, delimiter, fields)
        .writeStream.format("parquet")
        .partitionBy("rejected")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(seconds))
        .start(target)
    )


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark has given the stream of a checkpoint: the same after a restart, another for a new checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def append_lines_jdbc(
    lines: DataFrame,
    url: str,
    table: str,
    checkpoint: str,
    properties: dict[str, str] | None = None,
    delimiter: str = "#",
    seconds: int | None = FLUSH_SECONDS,
    fields: Sequence[tuple[str, str]] = NAME_AGE,
    rejects: str | None = None,
) -> StreamingQuery:
    """Appends good lines to a database table that has the columns `stream_id` and `batch_id` too.

    The database does not know Spark's batches, so each one first deletes what an earlier try of it
    left behind: rows of this stream and batch only, since another checkpoint counts its batches
    from 0 again. Rejected lines go to the folder `rejects` (by default one beside the checkpoint's
    own files), a partition per stream and batch that a repeated batch replaces.
    A task that Spark repeats within a batch can still write its rows twice.
    """
    folder = rejects or f"{checkpoint.rstrip('/')}_rejects"

    def apply(batch: DataFrame, batch_id: int) -> None:
        own = stream_id(batch.sparkSession, checkpoint)
        good = batch.filter(~F.col("rejected")).select(
            *[name for name, _ in fields], F.lit(own).alias("stream_id"), F.lit(batch_id).alias("batch_id")
        )
        bad = batch.filter(F.col("rejected")).drop("rejected", *[name for name, _ in fields])
        bad.write.mode("overwrite").parquet(f"{folder}/stream_id={own}/batch_id={batch_id}")
        jdbc_execute(
            batch.sparkSession, url, f"DELETE FROM {table} WHERE stream_id = '{own}' AND batch_id = {batch_id}", properties
        )
        jdbc_append(good, url, table, properties)

    return (
        parse_lines(lines, delimiter, fields)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(seconds))
        .start()
    )


def read_lines(spark: SparkSession, target: str, rejected: bool = False) -> DataFrame:
    return spark.read.parquet(target).filter(F.col("rejected") == rejected).drop("rejected")
