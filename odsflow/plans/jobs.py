"""Table copies: read, conform, gate, write; one audit row per table."""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.operators.conform import Field, conform, fields_from_metadata
from odsflow.operators.key_index import KeyIndex, add_keys, open_index, with_known_keys
from odsflow.operators.metadata import exclude_names
from odsflow.operators.quality import (
    REASONS, BudgetExceeded, ErrorBudget, KeySpec, Rule, check_counts, enforce_budget, is_bad, split_good_bad,
    key_specs, with_key_reasons, with_reasons,
)
from odsflow.session import child_names, delete_folder
from odsflow.sinks.tables import columns_ddl, create_if_absent
from odsflow.sources.incremental import FIRST_LOAD, as_mark, read_mark, rows_above, rows_between, store_mark

CHANNELS = 3
BAD = "_bad"
AUDIT_SCHEMA = (
    "table_name string, status string, rows_in bigint, rows_out bigint, rejected bigint, "
    "error string, seconds double, unmarked bigint"
)


@dataclass(frozen=True)
class Incremental:
    """The column whose largest loaded value is the mark, and the folder of the stored marks."""

    column: str
    marks: str


@dataclass(frozen=True)
class CopyJob:
    """One table.

    `write` gets the good rows; for an incremental job also the mark they start after (see
    `sources.incremental.slice_writer`). `stage` names a shared folder to read the source only once
    (for databases, whose rows may change between two reads); without it the gate and the write each
    scan the source. Each run stages in a folder of its own below it. `keys` are the target's primary and unique keys; rows that break one are rejects.
    `key_index` names a folder for an index of the keys of earlier loads (incremental jobs only): a
    row whose key an earlier load brought is a reject too.
    """

    name: str
    read: Callable[[SparkSession], DataFrame]
    write: Callable[..., None]
    fields: list[Field] | None = None
    rules: tuple[Rule, ...] = ()
    keys: tuple[KeySpec, ...] = ()
    mode: str = "lossless"
    budget: ErrorBudget = ErrorBudget()
    write_rejects: Callable[[DataFrame], None] | None = None
    stage: str | None = None
    incremental: Incremental | None = None
    key_index: str | None = None


@dataclass(frozen=True)
class Audit:
    table_name: str
    status: str
    rows_in: int | None = None
    rows_out: int | None = None
    rejected: int | None = None
    error: str | None = None
    seconds: float | None = None
    unmarked: int | None = None


def jobs_from_columns(
    columns: DataFrame,
    reader: Callable[[str], Callable[[SparkSession], DataFrame]],
    writer: Callable[[str], Callable[[DataFrame], None]],
    only: list[str] | None = None,
    exclude: list[str] = (),
    dialect: str = "mysql",
    mode: str = "lossless",
    budget: ErrorBudget = ErrorBudget(),
    mark_columns: dict[str, str] | None = None,
    marks: str | None = None,
    tables: DataFrame | None = None,
    indexes: DataFrame | None = None,
    schema: str | None = None,
) -> list[CopyJob]:
    """One job per table of a metadata listing (all, or the named ones; minus the excluded).

    Tables in `mark_columns` load incrementally by that column, all others in full. With a listing of
    `tables` only base tables stay, with one of `indexes` the unique ones become the jobs' keys. A listing of several
    schemas needs `schema` as soon as two of them have a table of the same name; `plans.dictionary` makes jobs of all.

    `columns` has the shape of `fields_from_metadata` plus table_name and ordinal_position; its size
    is that of the source's data dictionary, so it may come to the driver.
    """
    wanted = exclude_names(_listing(columns, schema), "table_name", list(exclude))
    if only is not None:
        wanted = wanted.filter(F.lower("table_name").isin([name.lower() for name in only]))
    place = [c for c in ("table_schema", "table_name") if c in wanted.columns]
    if tables is not None:
        base = _listing(tables, schema).filter(F.upper("table_type") == "BASE TABLE").select(*place)
        wanted = wanted.join(base, place, "left_semi")
    found: dict[str, list[dict]] = {}
    schemas: dict[str, str] = {}
    for row in wanted.orderBy(*place, "ordinal_position").toLocalIterator():
        name, own = row["table_name"].lower(), row["table_schema"] if "table_schema" in place else ""
        if schemas.setdefault(name, own) != own:
            raise ValueError(f"the table {name} is in {schemas[name]} and in {own}; name the schema")
        found.setdefault(name, []).append(row.asDict())
    keys = {}
    if indexes is not None:
        listed = _listing(indexes, schema)
        for name, own in schemas.items():
            keys[name] = tuple(key_specs(listed.filter(F.col("table_schema") == own) if own else listed, name))
    by_mark = {name.lower(): Incremental(column, marks) for name, column in (mark_columns or {}).items()}
    return [
        CopyJob(
            name, reader(name), writer(name), fields_from_metadata(rows, dialect, mode), mode=mode, budget=budget,
            incremental=by_mark.get(name), keys=keys.get(name, ()),
        )
        for name, rows in found.items()
    ]


def _listing(rows: DataFrame, schema: str | None) -> DataFrame:
    """A metadata listing with lower-case column names (databases differ in case), of one schema if it is named."""
    rows = rows.toDF(*[name.lower() for name in rows.columns])
    return rows if schema is None else rows.filter(F.lower("table_schema") == schema.lower())


def _new_rows(spark: SparkSession, job: CopyJob, source: DataFrame) -> tuple[str | None, str | None, DataFrame]:
    """(stored mark, new mark, rows between them). The new mark is taken first, so rows that appear
    in the source during the load wait for the next one."""
    column = job.incremental.column
    stored = read_mark(spark, job.incremental.marks, job.name, column, source.schema[column].dataType)
    above = as_mark(source, column, stored)
    mark = rows_above(source, column, above).agg(F.max(column).cast("string")).first()[0]
    return stored, mark, rows_between(source, column, above, as_mark(source, column, mark))


def _key_indexes(spark: SparkSession, job: CopyJob) -> list[KeyIndex]:
    """The indexes of the job's keys, one folder each."""
    if not job.key_index:
        return []
    if not job.incremental:
        raise ValueError(f"{job.name}: a full copy replaces its keys, so only an incremental one has an index of earlier loads")
    return [open_index(spark, f"{job.key_index}/{key.name}", key) for key in job.keys]


def _stage(spark: SparkSession, checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame, int, int]:
    """Writes the checked rows once, good and bad apart, so that each later step reads only its part."""
    marked = checked.withColumn(BAD, is_bad())
    marked.write.mode("overwrite").partitionBy(BAD).parquet(path)
    staged = spark.read.schema(marked.schema).parquet(path)
    counts = {row[BAD]: row["count"] for row in staged.groupBy(BAD).count().collect()}
    bad = counts.get(True, 0)
    good, rejects = staged.filter(~F.col(BAD)).drop(BAD, REASONS), staged.filter(F.col(BAD)).drop(BAD)
    return good, rejects, bad + counts.get(False, 0), bad


def copy_table(spark: SparkSession, job: CopyJob) -> Audit:
    """Copies one table; the error budget is checked before the target is touched.

    Rows of an incremental source without a mark load with the first copy only; every audit row says
    how many there are (`unmarked`).
    """
    started = time.monotonic()
    stage = f"{job.stage.rstrip('/')}/run-{uuid.uuid4().hex}" if job.stage else None  # what a crashed run left does not matter
    source = job.read(spark)
    if not source.columns:
        return Audit(job.name, "skipped", error="no columns")
    stored, mark, unmarked = None, None, None
    if job.incremental:
        unmarked = source.filter(F.col(job.incremental.column).isNull()).count()
        stored, mark, source = _new_rows(spark, job, source)
    checked = conform(source, job.fields, job.mode) if job.fields else source
    checked = with_key_reasons(with_reasons(checked, list(job.rules)), job.keys)
    indexes = _key_indexes(spark, job)
    checked = with_known_keys(checked, indexes, stored or FIRST_LOAD)
    try:
        if stage:
            good, rejects, total, bad = _stage(spark, checked, stage)
            check_counts(total, bad, job.budget)
        else:
            total, bad = enforce_budget(checked, job.budget)
            good, rejects = split_good_bad(checked)
        if bad and job.write_rejects:
            job.write_rejects(rejects)
        if job.incremental:
            job.write(good, stored or FIRST_LOAD)
            for index in indexes:
                add_keys(index, good, stored or FIRST_LOAD)
            if mark is not None:
                store_mark(spark, job.incremental.marks, job.name, job.incremental.column, mark)
        else:
            job.write(good)
    finally:
        if stage:
            delete_folder(spark, stage)
            if not child_names(spark, job.stage):
                delete_folder(spark, job.stage)
    return Audit(job.name, "success", total, total - bad, bad, seconds=round(time.monotonic() - started, 3), unmarked=unmarked)


def _message(error: Exception) -> str:
    return str(error).strip() or type(error).__name__


def _copy_or_report(spark: SparkSession, job: CopyJob) -> Audit:
    try:
        return copy_table(spark, job)
    except BudgetExceeded as over:
        return Audit(job.name, "failed", over.total, 0, over.bad, str(over))
    except Exception as error:  # one table must not stop the rest
        return Audit(job.name, "failed", error=_message(error))


def copy_many(spark: SparkSession, jobs: list[CopyJob], channels: int = CHANNELS) -> DataFrame:
    """Copies the tables, `channels` at a time, and returns the audit rows."""
    with ThreadPoolExecutor(max_workers=max(1, channels)) as pool:
        audits = list(pool.map(lambda job: _copy_or_report(spark, job), jobs))
    rows = [(a.table_name, a.status, a.rows_in, a.rows_out, a.rejected, a.error, a.seconds, a.unmarked) for a in audits]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def tally(audit: DataFrame) -> DataFrame:
    """Tables per status."""
    return audit.groupBy("status").count().withColumnRenamed("count", "table_cnt")


def create_tables(
    spark: SparkSession, jobs: list[CopyJob], fmt: str = "parquet", folder: str | None = None,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Creates the declared table of each job in the session catalog unless it is there; audit rows.

    Partition columns (such as `dt`) are added as text columns when a table does not declare them.
    """
    rows = []
    for job in jobs:
        try:
            if not job.fields:
                rows.append((job.name, "skipped", None, None, None, "no columns", None, None))
                continue
            declared = {f.name for f in job.fields}
            extra = [Field(name, "string") for name in partition_by or [] if name not in declared]
            create_if_absent(
                spark, job.name, columns_ddl(job.fields + extra), f"{folder}/{job.name}" if folder else None,
                fmt, partition_by,
            )
            rows.append((job.name, "success", None, None, None, None, None, None))
        except Exception as error:  # one table must not stop the rest
            rows.append((job.name, "failed", None, None, None, _message(error), None, None))
    return spark.createDataFrame(rows, AUDIT_SCHEMA)
