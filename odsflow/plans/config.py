"""Jobs written down as JSON: what to read, which steps or columns, where to write.

A table copy:

    {"name": "orders",
     "source": {"kind": "jdbc", "url": "...", "table": "orders", "columns": ["id", "total"], "split_key": "id"},
     "columns": [{"name": "id", "type": "bigint", "required": true}, {"name": "total", "type": "decimal(12,2)"}],
     "sink": {"kind": "orc", "path": "..."},
     "budget": {"records": 0, "share": 0.02}}

With `"incremental": {"column": "changed_at", "marks": "..."}` only rows above the stored mark are read; the
sink kind `slices` keeps such loads apart, so that a repeated one replaces itself. `"key_index": "..."` beside it names a folder for the
keys of earlier loads; a row whose key (see `keys`) is there is a reject.

An ETL: `{"sources": {view: source}, "steps": [{"view", "sql"}], "sink": {...}}`.

A stream, run every `seconds` (without it: once over all that is there):

    {"source": {"kind": "kafka", "servers": "...", "topic": "..."},
     "flow": {"kind": "lines", "delimiter": "#", "target": "...", "checkpoint": "..."}, "seconds": 10}

Flows: `lines`, `lines_jdbc`, `changes` (lake), `feed` (a raw feed into the lake), `changes_jdbc`, `inserts`, `alerts`, `summary`
(kept up from a raw feed; its key `summary` has `group`, `sums`, `unit` and `where`); their other keys are the
arguments of the function behind them. Messages of all but the first two are JSON of the schema in `source`.
"""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from odsflow.operators.changes import from_json_lines
from odsflow.operators.conform import Field
from odsflow.operators.quality import ErrorBudget, KeySpec
from odsflow.plans.jobs import CHANNELS, CopyJob, Incremental, copy_many
from odsflow.plans.steps import Step, run_steps
from odsflow.sinks import jdbc as jdbc_sink, tables as table_sink
from odsflow.sinks.clustered import save_clustered
from odsflow.sources import jdbc as jdbc_source
from odsflow.sources.incremental import rows_above, slice_writer
from odsflow.sources.kafka import kafka_lines
from odsflow.streaming.alerts import append_alerts
from odsflow.streaming.delimited import append_lines, append_lines_jdbc
from odsflow.streaming.summaries import Summary, summarise_feed
from odsflow.streaming.upsert import append_inserts, upsert_feed, upsert_stream, upsert_stream_jdbc

FILE_KINDS = ("parquet", "orc", "csv", "json")


def _options(entry: dict, *skipped: str) -> dict:
    return {key: value for key, value in entry.items() if key not in ("kind", *skipped)}


def read_source(spark: SparkSession, entry: dict) -> DataFrame:
    """The table a source entry names; `above` = [column, value] keeps the rows above a mark."""
    kind = entry["kind"]
    if kind == "jdbc":
        df = jdbc_source.jdbc_column_read(spark, **_options(entry, "above"))
    elif kind in FILE_KINDS:
        reader = spark.read.format(kind).options(**entry.get("options", {}))
        if "schema" in entry:
            reader = reader.schema(entry["schema"])
        df = reader.load(entry["path"])
        df = df.select(*entry["columns"]) if "columns" in entry else df
    else:
        raise ValueError(f"unknown source kind {kind!r}")
    if "above" not in entry:
        return df
    column, mark = entry["above"]
    return rows_above(df, column, F.lit(mark).cast(df.schema[column].dataType))


SINKS: dict[str, Callable[..., None]] = {
    "jdbc_append": jdbc_sink.jdbc_append,
    "jdbc_truncate": jdbc_sink.jdbc_truncate_load,
    "jdbc_upsert": jdbc_sink.jdbc_upsert,
    "text": table_sink.overwrite_text,
    "orc": table_sink.append_orc,
    "parquet": table_sink.append_parquet,
    "parquet_overwrite": table_sink.overwrite_parquet,
    "partitions": table_sink.overwrite_partitions,
    "partitions_append": table_sink.append_partitioned,
    "bucketed": table_sink.save_bucketed,
    "clustered": save_clustered,
}


def write_sink(df: DataFrame, entry: dict) -> None:
    if entry["kind"] not in SINKS:
        raise ValueError(f"unknown sink kind {entry['kind']!r}")
    SINKS[entry["kind"]](df, **_options(entry))


def copy_job(entry: dict) -> CopyJob:
    """A database may change between two reads, so its copy needs a `stage`: the rows that are written are those checked."""
    if entry["source"]["kind"] == "jdbc" and not entry.get("stage"):
        raise ValueError(f"the copy {entry['name']!r} reads a database and needs a stage")
    fields = [Field(**{**column, "domain": tuple(column.get("domain", ()))}) for column in entry.get("columns", [])]
    rejects, incremental = entry.get("rejects"), entry.get("incremental")

    def write(df: DataFrame, *start: str) -> None:
        if entry["sink"]["kind"] == "slices":  # one partition per incremental load, replaced by a rerun
            slice_writer(entry["sink"]["path"])(df, *start)
        else:
            write_sink(df, entry["sink"])

    return CopyJob(
        name=entry["name"],
        read=lambda spark: read_source(spark, entry["source"]),
        write=write,
        fields=fields or None,
        keys=tuple(KeySpec(k["name"], tuple(k["columns"]), k.get("primary", False)) for k in entry.get("keys", [])),
        mode=entry.get("mode", "lossless"),
        budget=ErrorBudget(**entry.get("budget", {})),
        write_rejects=(lambda df: write_sink(df, rejects)) if rejects else None,
        stage=entry.get("stage"),
        incremental=Incremental(**incremental) if incremental else None,
        key_index=entry.get("key_index"),
    )


def run_copies(spark: SparkSession, path: str) -> DataFrame:
    """Runs the copies of a JSON file `{"channels": n, "copies": [...]}` and returns the audit."""
    with open(path, encoding="utf-8") as source:
        config = json.load(source)
    return copy_many(spark, [copy_job(entry) for entry in config["copies"]], config.get("channels", CHANNELS))


def run_etl(spark: SparkSession, path: str) -> DataFrame:
    """Runs the ETL of a JSON file; returns the result it wrote (lazily, for a look)."""
    with open(path, encoding="utf-8") as source:
        config = json.load(source)
    views = {view: read_source(spark, entry) for view, entry in config["sources"].items()}
    result = run_steps(spark, views, [Step(s["view"], s["sql"]) for s in config["steps"]])
    write_sink(result, config["sink"])
    return result


def stream_source(spark: SparkSession, entry: dict) -> DataFrame:
    """A topic or a folder of text files as lines; with a `schema` the lines are JSON rows."""
    kind = entry["kind"]
    if kind == "kafka":
        lines = kafka_lines(spark, **_options(entry, "schema"))
    elif kind == "files":
        lines = spark.readStream.options(**entry.get("options", {})).text(entry["path"])
    else:
        raise ValueError(f"unknown stream source {kind!r}")
    return from_json_lines(lines, entry["schema"]) if "schema" in entry else lines


def summary_flow(rows: DataFrame, summary: dict, **options) -> StreamingQuery:
    """The upkeep of a summary (see `streaming.summaries.Summary`) from a raw change feed."""
    return summarise_feed(rows, summary=Summary(**summary), **options)


FLOWS: dict[str, Callable[..., StreamingQuery]] = {
    "lines": append_lines,
    "lines_jdbc": append_lines_jdbc,
    "changes": upsert_stream,
    "feed": upsert_feed,
    "changes_jdbc": upsert_stream_jdbc,
    "inserts": append_inserts,
    "alerts": append_alerts,
    "summary": summary_flow,
}


def start_stream(spark: SparkSession, path: str) -> StreamingQuery:
    """Starts the stream of a JSON file."""
    with open(path, encoding="utf-8") as source:
        config = json.load(source)
    flow = config["flow"]
    if flow["kind"] not in FLOWS:
        raise ValueError(f"unknown flow {flow['kind']!r}")
    rows = stream_source(spark, config["source"])
    return FLOWS[flow["kind"]](rows, **_options(flow), seconds=config.get("seconds"))
