"""File tables: text, ORC, parquet; appended, replaced, partitioned, bucketed.

Partitioned writes ask for a rebalance by the partition columns: few files per partition, while
AQE cuts a partition that holds most of the rows into several tasks.
"""

from __future__ import annotations

import re
import uuid
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from odsflow.functions.text import escape_line_breaks
from odsflow.operators.conform import Field
from odsflow.session import child_names, delete_folder, replace_folder, restore_folder

DYNAMIC = {"partitionOverwriteMode": "dynamic"}
BUCKET = "_bucket"
ROWS_PER_BUCKET = 5_000_000
MOST_BUCKETS = 100_000
DROP_AT_ONCE = 500
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def overwrite_text(df: DataFrame, path: str, delimiter: str = ",", max_rows_per_file: int = 0) -> None:
    """Delimited text, replaced each run; one row is one line, whatever its texts hold.

    Line breaks and backslashes in texts are escaped, fields holding the delimiter or quotes are
    quoted, and NULL is written as \\N (the text \\N as \\\\N), so every text survives and the files can
    be split. `read_text_table` undoes it.
    """
    texts = {f.name: escape_line_breaks(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, StringType)}
    (
        df.withColumns(texts).write.mode("overwrite")
        .options(
            sep=delimiter, escape='"', nullValue="\\N", maxRecordsPerFile=max_rows_per_file,
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )


def append_orc(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("compression", "snappy").orc(path)


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_parquet(df: DataFrame, path: str) -> None:
    """Replaces a path table. The new rows are written beside it first, so a write that fails leaves the old ones.

    If the folders cannot be exchanged, both versions are kept and the error names where they are.
    """
    spark, fresh = df.sparkSession, f"{path.rstrip('/')}__new_{uuid.uuid4().hex}"
    restore_folder(spark, path)
    try:
        df.write.parquet(fresh)
    except Exception:
        delete_folder(spark, fresh)
        raise
    replace_folder(spark, fresh, path)


def append_partitioned(df: DataFrame, path: str, by: list[str], fmt: str = "parquet") -> None:
    df.hint("rebalance", *by).write.mode("append").partitionBy(*by).format(fmt).save(path)


def overwrite_partitions(df: DataFrame, path: str, by: list[str], fmt: str = "parquet") -> None:
    """Replaces only the partitions that occur in the load, so that a rerun of a day is idempotent.

    A day without a row in the load stays as it is.
    """
    df.hint("rebalance", *by).write.mode("overwrite").options(**DYNAMIC).partitionBy(*by).format(fmt).save(path)


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET, least: int = 8) -> int:
    """Buckets for a table expected to hold that many rows; to be fixed once, when the table is made.

    More than Spark allows is an error: the rows per bucket have to be raised then.
    """
    buckets = max(least, -(-rows // rows_per_bucket))
    if buckets > MOST_BUCKETS:
        raise ValueError(f"{buckets} buckets are more than Spark's {MOST_BUCKETS}; raise rows_per_bucket")
    return buckets


def save_bucketed(
    df: DataFrame,
    table: str,
    path: str,
    buckets: int,
    keys: list[str],
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """A catalog table in buckets of its key, optionally partitioned and sorted.

    Rows are first rebalanced by partition and bucket, so that a bucket gets few files and a hot
    bucket is written by several tasks. A later join or grouping gives each bucket to one task, so
    size their number to the table (`bucket_count`).
    """
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    spread = df.withColumn(BUCKET, bucket).hint("rebalance", *(partition_by or []), BUCKET).drop(BUCKET)
    writer = spread.write.mode(mode).option("path", path).bucketBy(buckets, *keys)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format("parquet").saveAsTable(table)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def columns_ddl(fields: list[Field]) -> str:
    """Declared columns as Spark DDL with NOT NULL, DEFAULT and COMMENT."""
    lines = []
    for item in fields:
        line = f"`{item.name}` {item.type}"
        if item.required:
            line += " NOT NULL"
        if item.default is not None:
            word = item.default.upper()
            if word in ("CURRENT_TIMESTAMP", "NOW()"):
                line += " DEFAULT CURRENT_TIMESTAMP()"
            elif word == "NULL":
                line += " DEFAULT NULL"
            else:
                line += f" DEFAULT CAST({_quoted(item.default)} AS {item.type})"
        if item.comment:
            line += f" COMMENT {_quoted(item.comment)}"
        lines.append(line)
    return ", ".join(lines)


def create_if_absent(
    spark: SparkSession,
    table: str,
    columns: str,
    path: str | None = None,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    comment: str | None = None,
) -> None:
    """`columns` is Spark DDL and may hold DEFAULT and COMMENT clauses; text tables use csv."""
    statement = f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {'csv' if fmt == 'textfile' else fmt}"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(partition_by)})"
    if path:
        statement += f" LOCATION '{path}'"
    if comment:
        statement += f" COMMENT {_quoted(comment)}"
    spark.sql(statement)


def kept_days(df: DataFrame, day: str, as_of, days: int = 30) -> DataFrame:
    """Rows of the last `days` days up to `as_of`; on a partition column this prunes files."""
    return df.filter(F.col(day) >= F.date_sub(F.lit(as_of).cast("date"), days))


def _partition_spec(name: str) -> str:
    """`dt=2024-01-01/region=a` as listed by the catalog, as the PARTITION clause that drops it."""
    parts = [part.split("=", 1) for part in name.split("/")]
    values = [(k, "null" if v == NULL_PARTITION else _quoted(unquote(v))) for k, v in parts]
    return f"PARTITION ({', '.join(f'`{k}`={v}' for k, v in values)})"


def drop_expired(spark: SparkSession, table: str, day: str, as_of: str, days: int = 30) -> int:
    """Drops partitions older than the retention from the catalog and says how many went.

    Only partition names travel to the driver. Files of an external table stay for its owner.
    """
    value = F.regexp_extract("partition", rf"(?:^|/){day}=([^/]+)", 1)
    expired = spark.sql(f"SHOW PARTITIONS {table}").filter(
        value.try_cast("date") < F.date_sub(F.lit(as_of).cast("date"), days)
    )
    specs = [_partition_spec(row["partition"]) for row in expired.toLocalIterator()]
    for start in range(0, len(specs), DROP_AT_ONCE):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(specs[start:start + DROP_AT_ONCE])}")
    return len(specs)


def delete_expired_folders(spark: SparkSession, path: str, day: str, as_of: date, days: int = 30) -> list[str]:
    """Deletes the `day=yyyy-MM-dd` folders of a path table that are older than the retention.

    The day may be any level of the partitioning. Folders whose value is no date stay. Returns the
    names of those that went, from the table's folder on.
    """
    limit = as_of - timedelta(days=days)
    gone = []
    for name in sorted(child_names(spark, path)):
        column, _, value = name.partition("=")
        if column == day:
            if re.fullmatch(r"\d{4}-\d{2}-\d{2}", value) and date.fromisoformat(value) < limit:
                delete_folder(spark, f"{path}/{name}")
                gone.append(name)
        elif value:
            gone += [f"{name}/{below}" for below in delete_expired_folders(spark, f"{path}/{name}", day, as_of, days)]
    return gone
