"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator
from functools import lru_cache, wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from odsflow.session import scratch_path

ROOT = str(Path(__file__).resolve().parents[2])


def for_workers(run):
    """A query or stage whose first argument is the session, with this package on the Python workers' path.

    It serves sessions whose workers see the driver's code; elsewhere the package is shipped with --py-files.
    """

    @wraps(run)
    def with_path(spark, *args):
        environment = spark.sparkContext.environment
        known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if ROOT not in known:
            environment["PYTHONPATH"] = os.pathsep.join([*known, ROOT])
        return run(spark, *args)

    return with_path


#: For Python workers that share an executor's memory with a full heap: arrays of a megabyte or more go back to the system once they are
#: freed (by glibc's defaults a worker keeps some hundred MB of them), Arrow's too.
LEAN = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 22), "ARROW_DEFAULT_MEMORY_POOL": "system"}


def lean_workers(stage):
    """A stage whose first argument is the session, with LEAN for its Python functions where the session's environment does not say otherwise."""

    @wraps(stage)
    def with_settings(spark, *args):
        environment = spark.sparkContext.environment
        added = {k: v for k, v in LEAN.items() if k not in environment}
        environment.update(added)
        try:
            return stage(spark, *args)
        finally:
            for name in added:
                del environment[name]

    return with_settings


_remembering = []


def remembered(most: int):
    """`lru_cache` for what a worker keeps from task to task; `forget` drops it."""
    def kept(function):
        cached = lru_cache(maxsize=most)(function)
        _remembering.append(cached)
        return cached

    return kept


def forget() -> None:
    """Drops what this worker has kept for tasks of other operators."""
    if any(cached.cache_info().currsize for cached in _remembering):
        for cached in _remembering:
            cached.cache_clear()
        gc.collect()


def written(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The rows of `df`, written once to the cluster's shared folder and read from there.

    It cuts the lineage, survives lost executors, and nothing behind it runs twice. Without `compression`, the session's is used.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark, label)}/rows"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: list[tuple], **columns: pa.DataType) -> DataFrame:
    """A few rows of the driver as a table, by Arrow: no Python process of the executors unpacks them (and stays)."""
    cells = zip(*rows) if rows else [()] * len(columns)
    return spark.createDataFrame(pa.table({name: pa.array(each, kind) for (name, kind), each in zip(columns.items(), cells)}))


def named(column: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def utf8(column: Column) -> Column:
    """The bytes of a text; NULL is the empty text."""
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def text_key(text_col: str = "text") -> Column:
    """A hash of the text; NULL is the empty text."""
    return F.xxhash64(F.coalesce(named(text_col).cast("string"), F.lit(""))).alias("text_key")


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each whole row as the struct `row`, beside its key (`doc_id`, `text_key`)."""
    return docs.select(
        F.struct(*[named(c) for c in docs.columns]).alias("row"),
        named(id_col).cast("long").alias("doc_id"), text_key(text_col),
    )


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identity and text of each row: `doc_id`, `text_key` (hash of the text), `body` (bytes).

    Rows that agree in id and text are the same row to every operator here, so `doc_id` with
    `text_key` serves as the key of later joins; no generated row number is needed, which a
    repeated task could give anew.
    """
    return docs.select(
        named(id_col).cast("long").alias("doc_id"), text_key(text_col), utf8(named(text_col)).alias("body")
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on the row key; NULL ids are equal to each other."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def ranked(rows: DataFrame, order: list[Column], tree: str | None = None) -> DataFrame:
    """The rows with `rank`, their place from 0 in the order within each value of `tree`, and `size`, the rows of that value.

    The rows are written once, so that a repeated task sees the same ones, and sorted once, by range over all
    values of `tree` (no NULLs), so one value with most of the rows is dealt to many tasks; what is summed apart
    is one row a range and value. Rows equal in `order` are dealt by their place in the written table.
    """
    place, part, first = F.monotonically_increasing_id(), F.shiftright("place_", 33).alias("part_"), F.min("place_").alias("first_")
    tree_ = (named(tree) if tree else F.lit("")).alias("tree_")
    keys = [tree_, *[c.alias(f"order{i}_") for i, c in enumerate(order)], place.alias("mark_")]
    names = ["tree_", *[f"order{i}_" for i in range(len(order))], "mark_"]
    by = written(rows.select("*", *keys), "unsorted").repartitionByRange(*names).sortWithinPartitions(*names)
    by = written(by.select(*[named(c) for c in rows.columns], "tree_", place.alias("place_")), "sorted")
    parts = by.groupBy("tree_", part).agg(first, F.count(F.lit(1)).alias("n_"))
    whole = Window.partitionBy("tree_")
    before = F.sum("n_").over(whole.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1))
    starts = written(parts.select(
        "tree_", "part_", (F.coalesce(before, F.lit(0)) - F.col("first_")).alias("shift_"), F.sum("n_").over(whole).alias("size")
    ), "starts")
    found = by.withColumn("part_", part).join(starts, ["tree_", "part_"])
    return found.select(*[named(c) for c in rows.columns], (F.col("place_") + F.col("shift_")).alias("rank"), "size")


def in_chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts (`body`) of each part have about `size` bytes."""
    for batch in batches:
        group = np.cumsum(pc.binary_length(batch.column("body")).to_numpy().astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
        for first, end in zip(cuts, cuts[1:]):
            yield batch.slice(first, end - first)


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's long, bit for bit."""
    return np.ascontiguousarray(values, dtype=np.uint64).view(np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Sorted batches cut anew so that no group of equal `keys` spans two of them.

    Only the last, open group is carried over; the caller bounds the size of one group.
    """
    carried: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        carried.append(batch)
        last = {k: batch.column(k)[batch.num_rows - 1].as_py() for k in keys}
        cut = _start_of(batch, last, keys)
        if not cut and len(carried) > 1 and all(
            carried[-2].column(k)[carried[-2].num_rows - 1].as_py() == last[k] for k in keys
        ):
            continue
        closed = carried[:-1] + ([batch.slice(0, cut)] if cut else [])
        if closed:
            yield pa.Table.from_batches(closed).combine_chunks().to_batches()[0]
        carried = [batch.slice(cut)]
    if carried:
        yield pa.Table.from_batches(carried).combine_chunks().to_batches()[0]


def _start_of(batch: pa.RecordBatch, group: dict, keys: tuple[str, ...]) -> int:
    """The first row of the batch's last group."""
    low, high = 0, batch.num_rows - 1  # rows are sorted, so rows equal to the last one form a suffix
    while low < high:
        mid = (low + high) // 2
        if all(batch.column(k)[mid].as_py() == group[k] for k in keys):
            high = mid
        else:
            low = mid + 1
    return low


def group_starts(*columns: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal rows."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new) > 1:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)
