"""A change monitor: every row change as a readable record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from odsflow.operators.changes import KINDS, alerts, normalise_changes
from odsflow.streaming.triggers import trigger_options


def append_alerts(
    feed: DataFrame,
    target: str,
    checkpoint: str,
    databases: list[str] | None = None,
    tables: list[str] | None = None,
    kinds: list[str] | tuple[str, ...] = KINDS,
    fmt: str = "json",
    seconds: int | None = None,
) -> StreamingQuery:
    """Follows a raw change feed and appends the records of the named tables; a restart goes on where
    the checkpoint stands."""
    return (
        alerts(normalise_changes(feed, databases, tables, kinds))
        .writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(seconds))
        .start(target)
    )
