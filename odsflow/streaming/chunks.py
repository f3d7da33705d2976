"""The first full copy of a table in key chunks, while the table goes on changing.

A chunk is read between two positions of the change log: `low`, taken before the read, and `high`, taken after it. What the read saw of the
changes between them is unknown, so the log decides there: a chunk's rows count as of `low`, and every event of a
key above `low` replaces its row. At or below `low` the chunk decides. So chunks may be read in any order, several at once and
again after a failure, while the log is applied in batches of its own; the state is that of the table once the log has passed every chunk's `high`.

The log has to begin at or below the first chunk's `low` and to hold whole rows and deletes. Layout under `root`, beside that of
`streaming.upsert`: `chunks/chunk=N` rows, `chunk_marks/chunk=N` positions, written last: a chunk counts once it has one.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.functions.ranges import quantile_edges, range_predicates
from odsflow.operators.changes import latest_per_key, live_rows, merge_state
from odsflow.session import child_names, path_exists
from odsflow.streaming.upsert import finished_folders, full_state

ROWS_PER_CHUNK, CHANNELS = 8192, 3
POSITION, FROM_SNAPSHOT = "seq", "from_snapshot"
#: Order of changes: at the same position the chunk's row is the later one, since it was read behind that event.
ORDER = [POSITION, FROM_SNAPSHOT]
MARKS = "chunk int, low long, high long, predicate string"


def chunk_predicates(keys: DataFrame, key: str, rows: int, rows_per_chunk: int = ROWS_PER_CHUNK) -> list[str]:
    """SQL predicates that cut a table of about `rows` rows into chunks; each row falls under exactly one."""
    chunks = max(1, -(-rows // rows_per_chunk))
    return range_predicates(key, quantile_edges(keys, key, chunks, max(10_000, 10 * chunks)))


def log_changes(changes: DataFrame) -> DataFrame:
    """Change rows (op, seq, columns) as they have to go into `streaming.upsert` beside chunks."""
    return changes.withColumn(FROM_SNAPSHOT, F.lit(0))


def finished_chunks(spark: SparkSession, root: str) -> list[int]:
    names = [n for n in child_names(spark, f"{root}/chunk_marks") if n.startswith("chunk=")]
    return sorted(int(n.split("=", 1)[1]) for n in names if path_exists(spark, f"{root}/chunk_marks/{n}/_SUCCESS"))


def copy_chunk(
    spark: SparkSession, number: int, predicate: str, read: Callable[[str], DataFrame], position: Callable[[], int], root: str
) -> None:
    """Reads one chunk between two positions and stores its rows, then its mark."""
    low = position()
    rows = read(predicate).withColumns({"op": F.lit("I"), POSITION: F.lit(low).cast("long"), FROM_SNAPSHOT: F.lit(1)})
    rows.write.mode("overwrite").parquet(f"{root}/chunks/chunk={number}")
    high = position()
    if high < low:
        raise ValueError(f"the log's position went back from {low} to {high}")
    mark = spark.createDataFrame([(number, low, high, predicate)], MARKS)
    mark.coalesce(1).write.mode("overwrite").parquet(f"{root}/chunk_marks/chunk={number}")


def copy_chunks(
    spark: SparkSession, predicates: list[str], read: Callable[[str], DataFrame], position: Callable[[], int], root: str,
    only: list[int] | None = None, channels: int = CHANNELS,
) -> list[int]:
    """Copies the chunks that are not there yet (all, or those named), `channels` at a time; returns their numbers.

    `read` gives the table's rows under a predicate as they are at that moment, `position` the log's newest position. The
    predicates have to be those of the first start: a resumed copy compares them with the marks.
    """
    marks = chunk_marks(spark, root)
    known = {} if marks is None else {r["chunk"]: r["predicate"] for r in marks.collect()}  # one row a chunk
    changed = [n for n, p in known.items() if n >= len(predicates) or predicates[n] != p]
    if changed:
        raise ValueError(f"chunks {changed[:5]} were copied under other predicates")
    wanted = [n for n in (range(len(predicates)) if only is None else only) if n not in known]
    with ThreadPoolExecutor(max_workers=max(1, channels)) as pool:
        list(pool.map(lambda n: copy_chunk(spark, n, predicates[n], read, position, root), wanted))
    return wanted


def chunk_marks(spark: SparkSession, root: str) -> DataFrame | None:
    """(chunk, low, high, predicate) of the finished chunks."""
    finished = finished_chunks(spark, root)
    if not finished:
        return None
    return spark.read.schema(MARKS).option("basePath", f"{root}/chunk_marks").parquet(*[f"{root}/chunk_marks/chunk={n}" for n in finished])


def chunk_rows(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows of all finished chunks, as changes."""
    finished = finished_chunks(spark, root)
    return spark.read.parquet(*[f"{root}/chunks/chunk={n}" for n in finished]) if finished else None


def chunked_state(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """One row per key ever seen, deleted ones included: the log's state and the chunks' rows, whichever is later."""
    rows = chunk_rows(spark, root)
    has_log = finished_folders(spark, f"{root}/base", "upto") or finished_folders(spark, f"{root}/changes", "batch_id")
    if rows is None:
        return full_state(spark, root, keys, ORDER)
    rows = latest_per_key(rows, keys, ORDER)  # a repeated read of a moved key can show it in two chunks
    if not has_log:
        return rows
    log = full_state(spark, root, keys, ORDER)
    return merge_state(rows, log.select(*rows.columns), keys, ORDER)


def current_rows(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """The table as far as chunks and log have come (see `unsettled_chunks`)."""
    return live_rows(chunked_state(spark, root, keys))


def unsettled_chunks(spark: SparkSession, root: str, position: int) -> list[int]:
    """Chunks whose `high` the log, applied up to `position`, has not reached: their rows may be ahead of it."""
    marks = chunk_marks(spark, root)
    return [] if marks is None else sorted(r["chunk"] for r in marks.filter(F.col("high") > position).collect())


def replaced_rows(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """Per finished chunk: chunk, low, high, rows, and how many of its rows a later event has replaced."""
    marks, rows = chunk_marks(spark, root), chunk_rows(spark, root)
    if marks is None:
        return spark.createDataFrame([], "chunk int, low long, high long, rows long, replaced long")
    numbered = spark.read.option("basePath", f"{root}/chunks").parquet(
        *[f"{root}/chunks/chunk={n}" for n in finished_chunks(spark, root)]
    ).select("chunk", *keys, POSITION)
    log = full_state(spark, root, keys, ORDER).select(F.struct(*keys).alias("_key"), F.col(POSITION).alias("_seq"))
    same = F.struct(*keys) == F.col("_key")
    counted = numbered.join(log, same & (F.col("_seq") > F.col(POSITION)), "left").groupBy("chunk").agg(
        F.count(F.lit(1)).alias("rows"), F.count("_seq").alias("replaced")
    )
    zero = F.lit(0).cast("long")
    return marks.join(counted, "chunk", "left").select(
        "chunk", "low", "high", F.coalesce("rows", zero).alias("rows"), F.coalesce("replaced", zero).alias("replaced")
    )
