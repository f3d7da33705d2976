"""Tables clustered by key range: sorted across files, with an index of what each file holds.

Buckets spread keys by hash, so a range touches all of them. Here every file is one range of the key columns; a key with most of the rows
is cut by the columns behind it. `_files` lists the lowest and highest key of each file, so that a read opens only the files that can hold what it asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROWS_PER_FILE = 2_000_000
#: Rows a task of the write sorts at least, once there are TASKS_PER_CORE tasks for every core.
ROWS_PER_TASK, TASKS_PER_CORE = 1_000_000, 3
INDEX = "_files"


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def save_clustered(df: DataFrame, path: str, by: list[str], rows: int | None = None, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Writes a new table in ranges of `by` (leading key first, then what cuts a hot key); returns the number of its files.

    Spark samples the whole tuple for its ranges, so a key that fills several of them is cut by the columns behind it. A task's
    range is sorted and cut every `rows_per_file` rows, so the sample and the task results that reach the driver go by the tasks, not by
    the files. Rows with a NULL key come first. `rows` saves the count.
    """
    if rows is None:
        rows = df.count()
    files = max(1, -(-rows // rows_per_file))
    tasks = min(files, max(-(-rows // ROWS_PER_TASK), TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism))
    keys = [_name(c) for c in by]
    ranges = df.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    ranges.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows")
    return index_files(df.sparkSession, path, by)


def index_files(spark: SparkSession, path: str, by: list[str]) -> int:
    """Writes the index of a clustered table: per file its rows, and the lowest and highest key; one pass over the key columns."""
    rows = spark.read.parquet(f"{path}/rows")
    key = F.struct(*[_name(c).alias(c) for c in by])
    found = rows.select(F.col("_metadata.file_name").alias("file"), key.alias("key")).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    found.coalesce(1).write.mode("overwrite").parquet(f"{path}/{INDEX}")
    return spark.read.parquet(f"{path}/{INDEX}").count()


def files_between(spark: SparkSession, path: str, column: str, low=None, high=None) -> list[str]:
    """Names of the files that can hold rows with `low <= column <= high`; `column` is the leading key, None means no bound.

    The index has a row a file, and its filter runs as a job; only the chosen names come to the driver.
    """
    index = spark.read.parquet(f"{path}/{INDEX}")
    wanted = F.lit(True)
    if low is not None:
        wanted = wanted & (F.col("high").getField(column) >= F.lit(low))
    if high is not None:
        first = F.col("low").getField(column)
        wanted = wanted & (first.isNull() | (first <= F.lit(high)))
    return sorted(r["file"] for r in index.filter(wanted).select("file").collect())


def read_between(spark: SparkSession, path: str, column: str, low=None, high=None) -> DataFrame:
    """The rows with `low <= column <= high`; other files are not opened. Rows without a key lie in no range."""
    schema = spark.read.parquet(f"{path}/rows").schema
    files = files_between(spark, path, column, low, high)
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{path}/rows/{name}" for name in files])
    for bound, inside in ((low, _name(column) >= F.lit(low)), (high, _name(column) <= F.lit(high))):
        if bound is not None:
            rows = rows.filter(inside)
    return rows.filter(_name(column).isNotNull())
