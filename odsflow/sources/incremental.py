"""Incremental loads: rows above a stored high-water mark.

Marks live in small append-only parquet tables, one per table and one row per load, as text in the
session time zone (keep it at UTC). A crash between the write of
the rows and that of the mark repeats the load from the same start; `slice_writer` then replaces
the slice of the first try.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType

from odsflow.session import child_names

FIRST_LOAD = "initial"
MARK_SCHEMA = "mark string, loaded_at timestamp"


@dataclass(frozen=True)
class LoadResult:
    rows: int
    unmarked_rows: int
    mark: str | None


def rows_above(df: DataFrame, column: str | None, mark: Column | None) -> DataFrame:
    """Rows strictly above the mark (pushed down to the source); no column or mark: all rows."""
    return df if column is None or mark is None else df.filter(F.col(column) > mark)


def rows_between(df: DataFrame, column: str, mark: Column | None, upper: Column | None) -> DataFrame:
    """Rows above the mark up to the new one; the first load (no mark) also takes NULLs."""
    df = rows_above(df, column, mark)
    if upper is None:
        return df
    within = F.col(column) <= upper
    return df.filter(within | F.col(column).isNull()) if mark is None else df.filter(within)


def as_mark(df: DataFrame, column: str, text: str | None) -> Column | None:
    """A stored mark as a literal of the column's type."""
    return None if text is None else F.lit(text).cast(df.schema[column].dataType)


def _folder(marks: str, table: str, column: str) -> str:
    """Each table has its own folder: loads that run side by side must not share an output folder."""
    return f"{marks}/{table}.{column}"


def read_mark(spark: SparkSession, marks: str, table: str, column: str, kind: DataType | None = None) -> str | None:
    """The largest stored mark, compared as `kind`; without a kind the one stored last."""
    folder = _folder(marks, table, column)
    if not any(name.endswith(".parquet") for name in child_names(spark, folder)):
        return None
    return spark.read.schema(MARK_SCHEMA).parquet(folder).agg(
        F.max_by("mark", F.col("mark").cast(kind) if kind else F.col("loaded_at"))
    ).first()[0]


def store_mark(spark: SparkSession, marks: str, table: str, column: str, mark: str) -> None:
    row = spark.range(1, numPartitions=1).select(
        F.lit(mark).alias("mark"), F.current_timestamp().alias("loaded_at")
    )
    row.write.mode("append").parquet(_folder(marks, table, column))


def slice_writer(target: str) -> Callable[[DataFrame, str], None]:
    """Writes each load into a partition named after its start mark, replaced by a repeated load."""
    def write(df: DataFrame, start: str) -> None:
        stamped = df.withColumn("loaded_after", F.lit(start))
        stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "loaded_after"
        ).parquet(target)

    return write


def unmarked_writer(target: str) -> Callable[[DataFrame], None]:
    """Keeps the rows without a mark in a folder of their own; each load replaces it with those there are now."""
    return lambda df: df.write.mode("overwrite").parquet(target)


def incremental_load(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    column: str,
    marks: str,
    write: Callable[[DataFrame, str], None],
    overlap: Column | None = None,
    write_unmarked: Callable[[DataFrame], None] | None = None,
) -> LoadResult:
    """Loads the rows above the stored mark, then stores the largest value among them.

    The new mark and the counts come out of the write itself; rows without a mark are counted, and kept,
    by scans of their own, which a source may answer from its statistics or an index. `write`
    gets the rows and the start mark (`initial` at first); it has to be a file write without a
    shuffle. `overlap` (a number or interval) reads that far below the mark again, for rows that
    arrive late; `write` then has to upsert by key.

    Rows with a NULL in the column have no place in the order, so no later load can tell new ones
    from old. Every load counts all of them. With `write_unmarked` they are kept aside by every
    load (the writer replaces what it kept before, see `unmarked_writer`); without it the first load
    takes them along, and later ones only report them.
    """
    stored = read_mark(spark, marks, table, column, df.schema[column].dataType)
    mark = as_mark(df, column, stored)
    if mark is not None and overlap is not None:
        mark = mark - overlap
    seen = Observation()
    unmarked = df.filter(F.col(column).isNull())
    wanted = rows_above(df, column, mark)
    if write_unmarked:
        wanted = wanted.filter(F.col(column).isNotNull())
    wanted = wanted.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(F.col(column)).cast("string").alias("mark"))
    write(wanted, stored or FIRST_LOAD)
    result, without = seen.get, unmarked.count()
    if write_unmarked:
        write_unmarked(unmarked)
    if result["mark"] is not None and result["mark"] != stored:
        store_mark(spark, marks, table, column, result["mark"])
    return LoadResult(result["rows"], without, result["mark"] or stored)
