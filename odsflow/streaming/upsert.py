"""Row changes applied to a table by key.

Lake target: every micro-batch stores its last change per key in `changes/batch_id=N`. The state is
those rows merged with the newest `base/upto=N`, which `compact` writes now and then. A folder counts
once its `_SUCCESS` file is there, and a finished folder is never rewritten: a replayed batch is a
no-op and readers never see half a batch. The checkpoint lives beside the data, since batch
numbers only mean something together with it.

JDBC target: every micro-batch is merged in the database (`sinks.jdbc.jdbc_upsert`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from odsflow.operators.changes import latest_per_key, live_rows, merge_state, normalise_changes, to_changes
from odsflow.session import child_names, delete_folder, path_exists
from odsflow.sinks.jdbc import jdbc_upsert
from odsflow.streaming.triggers import FLUSH_SECONDS, trigger_options

KEEP_BASES = 2
FEED_ORDER = ["seq", "row_no"]


def finished_folders(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the complete `prefix=N` folders, ascending."""
    names = [name for name in child_names(spark, folder) if name.startswith(f"{prefix}=")]
    complete = [name for name in names if path_exists(spark, f"{folder}/{name}/_SUCCESS")]
    return sorted(int(name.split("=", 1)[1]) for name in complete)


def write_batch(changes: DataFrame, batch_id: int, root: str, keys: list[str], order: list[str]) -> None:
    spark = changes.sparkSession
    folder = f"{root}/changes/batch_id={batch_id}"
    if not path_exists(spark, f"{folder}/_SUCCESS"):
        latest_per_key(changes, keys, order).write.mode("overwrite").parquet(folder)


def load_snapshot(snapshot: DataFrame, root: str) -> None:
    """The first full copy (one row per key, lowest sequence) as the base below all batches.

    Only for a new state: below a later base it would never be read.
    """
    if any(b >= 0 for b in finished_folders(snapshot.sparkSession, f"{root}/base", "upto")):
        raise ValueError(f"{root} already has a base made from changes")
    snapshot.write.mode("overwrite").parquet(f"{root}/base/upto=-1")


def full_state(spark: SparkSession, root: str, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key ever seen, deleted keys included."""
    bases = finished_folders(spark, f"{root}/base", "upto")
    batches = [b for b in finished_folders(spark, f"{root}/changes", "batch_id") if not bases or b > bases[-1]]
    if not bases and not batches:
        raise ValueError(f"no state under {root}")
    base = spark.read.parquet(f"{root}/base/upto={bases[-1]}") if bases else None
    if not batches:
        return base
    folders = [f"{root}/changes/batch_id={b}" for b in batches]
    changes = latest_per_key(spark.read.parquet(*folders), keys, order)
    return changes if base is None else merge_state(base, changes.select(*base.columns), keys, order)


def current_rows(spark: SparkSession, root: str, keys: list[str], order: list[str]) -> DataFrame:
    """The table as it is now."""
    return live_rows(full_state(spark, root, keys, order))


def compact(spark: SparkSession, root: str, keys: list[str], order: list[str]) -> int | None:
    """Folds the finished batches into a new base; old folders stay for readers still on them."""
    batches = finished_folders(spark, f"{root}/changes", "batch_id")
    bases = finished_folders(spark, f"{root}/base", "upto")
    if not batches or (bases and batches[-1] <= bases[-1]):
        return None
    full_state(spark, root, keys, order).write.mode("overwrite").parquet(f"{root}/base/upto={batches[-1]}")
    return batches[-1]


def drop_superseded(spark: SparkSession, root: str, keep: int = KEEP_BASES) -> int:
    """Deletes bases older than the newest `keep` ones and the batches those already hold."""
    bases = finished_folders(spark, f"{root}/base", "upto")
    if len(bases) <= keep:
        return 0
    oldest_kept = bases[-keep]
    old = [f"{root}/base/upto={b}" for b in bases[:-keep]]
    old += [f"{root}/changes/batch_id={b}" for b in finished_folders(spark, f"{root}/changes", "batch_id") if b <= oldest_kept]
    for folder in old:
        delete_folder(spark, folder)
    return len(old)


def upsert_stream(
    changes: DataFrame,
    root: str,
    keys: list[str],
    order: list[str],
    seconds: int | None = None,
    compact_every: int | None = None,
    keep_bases: int = KEEP_BASES,
) -> StreamingQuery:
    """Starts the upsert of a change stream into the lake table under `root`.

    Every batch does the same work: it stores its last change per key. Run `compact` and
    `drop_superseded` as a job of their own, also while the stream goes on. With `compact_every` the
    stream itself folds its batches into a new base that often, which rewrites the whole state, and
    drops data older than the newest `keep_bases` bases (keep two for readers still on the last one).
    """
    spark = changes.sparkSession
    checkpoint = f"{root}/_checkpoint"
    if not path_exists(spark, checkpoint) and child_names(spark, f"{root}/changes"):
        raise ValueError(f"{root} holds changes but no checkpoint; batch numbers would start again")

    def apply(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, root, keys, order)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, root, keys, order)
            drop_superseded(batch.sparkSession, root, keep_bases)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(seconds))
        .start()
    )


def upsert_feed(
    feed: DataFrame,
    root: str,
    keys: list[str],
    databases: list[str] | None = None,
    tables: list[str] | None = None,
    seconds: int | None = None,
) -> StreamingQuery:
    """Starts the upsert of a raw change feed (see `operators.changes.normalise_changes`) into the lake table.

    An update that moves a row to another key deletes it under the old one.
    """
    changes = to_changes(normalise_changes(feed, databases, tables), keys)
    return upsert_stream(changes, root, keys, FEED_ORDER, seconds)


def upsert_stream_jdbc(
    changes: DataFrame,
    url: str,
    target: str,
    keys: list[str],
    order: list[str],
    checkpoint: str,
    properties: dict[str, str] | None = None,
    seconds: int | None = FLUSH_SECONDS,
) -> StreamingQuery:
    """Starts the upsert of a change stream into a database table."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        jdbc_upsert(latest_per_key(batch, keys, order), url, target, keys, order, properties)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(seconds))
        .start()
    )


def append_inserts(changes: DataFrame, target: str, checkpoint: str, seconds: int | None = None) -> StreamingQuery:
    """Append mode: inserted rows only, each once."""
    return (
        changes.filter("op = 'I'")
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(seconds))
        .start(target)
    )
