"""The registered queries: each takes (spark, folder of the tables) and returns a DataFrame."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.functions.ranges import quantiles, skewed_predicates, slices_of
from odsflow.functions.text import distinct_chars, scrub
from odsflow.functions.types import target_type
from odsflow.operators.changes import alerts, latest_state, normalise_changes
from odsflow.operators.conform import Field, conform, fields_from_metadata, fill_absent
from odsflow.operators.metadata import column_inventory, exclude_names, ordered_columns
from odsflow.operators.quality import (
    REASONS, ErrorBudget, KeySpec, budget_report, in_domain, key_report, key_violations, max_length, not_null,
    split_good_bad,
)
from odsflow.plans import fixtures
from odsflow.plans.jobs import CopyJob, copy_many, copy_table, tally
from odsflow.plans.steps import Step, daily_order_steps, run_steps
from odsflow.session import scratch_path
from odsflow.sinks import tables as sink
from odsflow.sources.incremental import FIRST_LOAD, incremental_load, rows_above, slice_writer, unmarked_writer
from odsflow.sources.tables import read_table, read_text_table
from odsflow.streaming.alerts import append_alerts
from odsflow.streaming.delimited import append_lines, parse_lines, read_lines
from odsflow.streaming.upsert import (
    FEED_ORDER, append_inserts, compact, current_rows, load_snapshot, upsert_feed, upsert_stream,
)

USER_KEY, EVENT_ORDER = ["user_id"], ["ts", "event_id"]
READ_SLICES = 8
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


# --- SQL steps -------------------------------------------------------------------------------

def daily_order_summary(spark: SparkSession, folder: str) -> DataFrame:
    return run_steps(spark, {"ods_orders": fixtures.ods_orders(spark, folder)}, daily_order_steps(success="F"))


def dwd_orders(spark: SparkSession, folder: str) -> DataFrame:
    return run_steps(spark, {"ods_orders": fixtures.ods_orders(spark, folder)}, daily_order_steps(success="F")[:1])


def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").agg(F.count(F.lit(1)).alias("cnt"))


SHIPPING_STEPS = [
    Step("dwd_shipments", """
        SELECT trunc(l_shipdate, 'MM') AS month_start, l_returnflag,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
        FROM ods_lineitem WHERE l_quantity > 0"""),
    Step("dwm_month_flag", """
        SELECT month_start, l_returnflag, count(*) AS line_cnt, sum(amount) AS amount
        FROM dwd_shipments GROUP BY month_start, l_returnflag"""),
    Step("dws_ship_month", """
        SELECT date_format(month_start, 'yyyy-MM') AS ship_month, CAST(sum(line_cnt) AS BIGINT) AS line_cnt,
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN line_cnt ELSE 0 END) AS BIGINT) AS returned_cnt,
               CAST(sum(amount) AS DECIMAL(28,2)) AS total_amount
        FROM dwm_month_flag GROUP BY month_start"""),
]


def sql_steps(spark: SparkSession, folder: str) -> DataFrame:
    return run_steps(spark, {"ods_lineitem": read_table(spark, folder, "lineitem")}, SHIPPING_STEPS)


# --- reads -----------------------------------------------------------------------------------

def range_split_read(spark: SparkSession, folder: str) -> DataFrame:
    """Line items dealt, in one scan, to the slices that a database would be read in: about equal ones by supplier, a hot
    supplier cut by the order key. A row comes as often as slices have it, so every row comes once."""
    lines = read_table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"])
    hot = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_suppkey")).alias("supplier")  # a third of the rows
    skewed = lines.select("l_orderkey", "l_linenumber", hot)
    predicates = skewed_predicates("supplier", quantiles(skewed, "supplier", READ_SLICES), "l_orderkey")
    return skewed.withColumn("slice_no", F.explode(slices_of(predicates))).drop("slice_no")


def column_read(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"])


def incremental_rows(spark: SparkSession, folder: str) -> DataFrame:
    mark = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    return rows_above(fixtures.ods_orders(spark, folder), "order_time", mark)


def incremental_mark(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of a growing table: the second takes only what came after the first one's mark."""
    orders = fixtures.ods_orders(spark, folder)
    base = scratch_path(spark, "incremental")
    target, marks = f"{base}/rows", f"{base}/marks"
    early = orders.filter(F.col("order_time") < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
    for available in (early, orders):
        incremental_load(spark, available, "orders", "order_time", marks, slice_writer(target))
    loaded = spark.read.parquet(target)
    run = F.when(F.col("loaded_after") == FIRST_LOAD, 1).otherwise(2)
    return loaded.select("id", "order_time", "order_amount", run.alias("load_no"))


def incremental_null_marks(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of a table of which some rows have no mark: those are kept aside by each load and counted (load_no 0)."""
    orders = fixtures.unmarked_orders(spark, folder)
    base = scratch_path(spark, "unmarked")
    cut = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    early = orders.filter((F.col("order_time") < cut) | (F.col("order_time").isNull() & (F.col("id") % 100 == 0)))
    for available in (early, orders):
        result = incremental_load(
            spark, available, "orders", "order_time", f"{base}/marks", slice_writer(f"{base}/rows"),
            write_unmarked=unmarked_writer(f"{base}/aside"),
        )
    loaded = spark.read.parquet(f"{base}/rows")
    run = F.when(F.col("loaded_after") == FIRST_LOAD, 1).otherwise(2)
    aside = spark.read.schema(orders.schema).parquet(f"{base}/aside")
    return loaded.select("id", "order_time", run.alias("load_no")).unionByName(
        aside.select("id", "order_time", F.lit(0).alias("load_no"))
    ).withColumn("unmarked_rows", F.lit(result.unmarked_rows).cast("bigint"))


# --- writes ----------------------------------------------------------------------------------

def table_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends: finished orders, then all others."""
    orders, path = fixtures.ods_orders(spark, folder), scratch_path(spark, "append")
    finished = F.col("order_status") == "F"
    sink.append_parquet(orders.filter(finished), path)
    sink.append_parquet(orders.filter(~finished), path)
    return spark.read.schema(orders.schema).parquet(path)


def truncate_load(spark: SparkSession, folder: str) -> DataFrame:
    """The daily summary loaded twice: a rerun replaces the rows instead of doubling them."""
    path = f"{scratch_path(spark, 'truncate')}/dws_order_day"
    for _ in range(2):
        sink.overwrite_parquet(daily_order_summary(spark, folder), path)
    return spark.read.parquet(path)


def text_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    customer, path = read_table(spark, folder, "customer"), f"{scratch_path(spark, 'text')}/customer"
    sink.overwrite_text(customer, path)
    return read_text_table(spark, path, customer.schema)


def text_linefeeds(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line feeds, as a text table and back."""
    documents, path = read_table(spark, folder, "documents"), f"{scratch_path(spark, 'text')}/documents"
    sink.overwrite_text(documents, path)
    return read_text_table(spark, path, documents.schema)


def orc_append(spark: SparkSession, folder: str) -> DataFrame:
    customer, path = read_table(spark, folder, "customer"), f"{scratch_path(spark, 'orc')}/customer"
    sink.append_orc(customer, path)
    sink.append_orc(customer, path)
    return spark.read.schema(customer.schema).orc(path)


def partitioned_bucketed_load(spark: SparkSession, folder: str) -> DataFrame:
    orders = fixtures.ods_orders(spark, folder).withColumnRenamed("order_status", "dt")
    table, path = f"ods_orders_{uuid.uuid4().hex}", f"{scratch_path(spark, 'bucketed')}/orders"
    buckets = sink.bucket_count(orders.count())  # the count comes from file footers
    sink.save_bucketed(orders, table, path, buckets, ["id"], partition_by=["dt"], sort_by=["id"])
    spark.sql(f"DROP TABLE {table}")  # external: the files stay, the session catalog stays clean
    return spark.read.parquet(path)


def partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by month; then one month comes again with doubled amounts and replaces itself alone."""
    orders = fixtures.ods_orders(spark, folder).select("id", "order_amount", "order_time")
    path = f"{scratch_path(spark, 'monthly')}/orders"
    start, end = (F.lit(day).cast("timestamp_ntz") for day in ("1997-05-01 00:00:00", "1997-06-01 00:00:00"))
    again = orders.filter((F.col("order_time") >= start) & (F.col("order_time") < end)).withColumn(
        "order_amount", (F.col("order_amount") * 2).cast(fixtures.MONEY)
    )  # a range of the column itself, so the scan skips other months
    orders, again = (
        load.select("id", "order_amount", F.date_format("order_time", "yyyy-MM").alias("dt")) for load in (orders, again)
    )
    for load in (orders, again):
        sink.overwrite_partitions(load, path, ["dt"])
    stored = spark.read.schema(orders.schema).parquet(path)
    return stored.groupBy("dt").agg(
        F.count(F.lit(1)).alias("order_cnt"), F.sum("order_amount").alias("total_amount")
    )


def retention_30d(spark: SparkSession, folder: str) -> DataFrame:
    orders = fixtures.ods_orders(spark, folder)
    as_of = orders.agg(F.max("order_time").cast("date")).first()[0]
    return sink.kept_days(orders, "order_time", as_of, 30)


# --- metadata and text -----------------------------------------------------------------------

def inventory(spark: SparkSession, folder: str) -> DataFrame:
    return column_inventory({name: read_table(spark, folder, name) for name in TABLES})


def exclude_list(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return exclude_names(customer, "c_mktsegment", ["machinery", "Furniture"])


def exclude_table(spark: SparkSession, folder: str) -> DataFrame:
    """Events whose type is not named in a table of names in other letter case."""
    events = fixtures.events(spark, folder)
    names = events.filter(F.col("event_type").isin("error", "click")).select(F.initcap("event_type")).distinct()
    return exclude_names(events.select("event_id", "event_type"), "event_type", names)


def ordered_list_per_group(spark: SparkSession, folder: str) -> DataFrame:
    """Per table the columns without NULLs (those fit for a key), in column order."""
    filled = inventory(spark, folder).filter("is_nullable = 0")
    listed = ordered_columns(filled, ["table_name"], "ordinal_position", "column_name")
    return listed.select("table_name", F.array_join("column_names", ",").alias("column_names"))


def text_scrub(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents", ["doc_id", "lang", "text"]).select(
        "doc_id", F.upper("lang").alias("lang"), scrub(F.col("text")).alias("text")
    )


def type_lookup(spark: SparkSession, folder: str) -> DataFrame:
    texts = fixtures.type_strings(spark, folder)
    mysql = [target_type(F.col("mysql_type"), t).alias(t)
             for t in ("hive", "doris", "postgres", "postgres_copy", "hive_copy")]
    oracle = [target_type(F.col("oracle_type"), t).alias(t) for t in ("odps", "odps_copy")]
    return texts.select("*", *mysql, *oracle)


def distinct_letters(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part", ["p_partkey", "p_name"]).select(
        "p_partkey", distinct_chars(F.col("p_name")).alias("chars")
    )


# --- conformance and quality -----------------------------------------------------------------

EVENT_FIELDS = [
    Field("event_id", "bigint", required=True),
    Field("amount", "decimal(12,2)", source="s_val"),
    Field("amount_rounded", "decimal(12,1)", source="s_val"),
    Field("user_no", "int", source="s_int", required=True),
    Field("day", "date", source="s_date"),
]
LOAD_FIELDS = [f for f in EVENT_FIELDS if f.name != "amount_rounded"]


def _conformed(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    checked = conform(fixtures.untyped_events(fixtures.events(spark, folder)), EVENT_FIELDS, mode)
    return checked.select(*[f.name for f in EVENT_FIELDS], F.array_join(REASONS, ",").alias("reasons"))


def conform_types(spark: SparkSession, folder: str) -> DataFrame:
    return _conformed(spark, folder, "lossless")


def conform_types_reference(spark: SparkSession, folder: str) -> DataFrame:
    return _conformed(spark, folder, "reference")


WIDE_FIELDS = [
    Field("id", "bigint"), Field("as_double", "double", source="big"), Field("as_day", "date", source="stamp"),
    Field("text_day", "date", source="day_text"),
]


def conform_lossless_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers as doubles and timestamps as days: rows that a cast would change are named."""
    checked = conform(fixtures.wide_numbers(spark, folder), WIDE_FIELDS, "lossless")
    return checked.select(
        "id", F.col("as_double").cast("decimal(20,0)").alias("as_double"), "as_day", "text_day",
        F.array_join(REASONS, ",").alias("reasons"),
    )


def _rejects(df: DataFrame, rule, *columns: str) -> DataFrame:
    _, bad = split_good_bad(df, [rule])
    return bad.select(*columns, F.array_join(REASONS, ",").alias("reasons"))


def not_null_violations(spark: SparkSession, folder: str) -> DataFrame:
    untyped = fixtures.untyped_events(fixtures.events(spark, folder))
    return _rejects(untyped, not_null("s_int"), "event_id", "s_date")


def domain_violations(spark: SparkSession, folder: str) -> DataFrame:
    events = fixtures.events(spark, folder)
    return _rejects(events, in_domain("event_type", ["signup", "purchase", "view"]), "event_id", "event_type")


def length_violations(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents", ["doc_id", "text"])
    return _rejects(documents, max_length("text", 2000), "doc_id")


def primary_key_violations(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber"])
    return key_violations(lineitem, ["l_orderkey", "l_linenumber"])


def unique_key_violations(spark: SparkSession, folder: str) -> DataFrame:
    """A unique index over a column with NULLs, which do not collide."""
    untyped = fixtures.untyped_events(fixtures.events(spark, folder))
    return key_violations(untyped, ["s_int", "s_date"], primary=False)


def key_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A primary and two unique keys of lineitem in one report."""
    specs = [
        KeySpec("PRIMARY", ("l_orderkey", "l_linenumber"), primary=True),
        KeySpec("uk_part", ("l_orderkey", "l_partkey", "l_suppkey")),
        KeySpec("uk_all", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")),
    ]
    return key_report(read_table(spark, folder, "lineitem"), specs)


def default_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Customers lack three declared columns and keep their own values of the others."""
    fields = [
        Field("c_custkey", "bigint"),
        Field("c_mktsegment", "string", default="NONE"),
        Field("country_code", "string", default="ZZ"),
        Field("credit", "decimal(12,2)", default="100.50"),
        Field("closed_on", "date", default="NULL"),
    ]
    customer = read_table(spark, folder, "customer", ["c_custkey", "c_mktsegment"])
    return fill_absent(customer, fields).select(*[f.name for f in fields])


def _line_checks(spark: SparkSession, folder: str) -> DataFrame:
    lines = parse_lines(fixtures.delimited_lines(fixtures.events(spark, folder)))
    reason = F.when(F.col("rejected"), F.array(F.lit("line"))).otherwise(F.array().cast("array<string>"))
    return lines.withColumn(REASONS, reason)


def error_budget(spark: SparkSession, folder: str) -> DataFrame:
    return budget_report(_line_checks(spark, folder), ErrorBudget(records=None, share=0.02))


# --- jobs over many tables -------------------------------------------------------------------

def _copy_jobs(folder: str, base: str, names) -> list[CopyJob]:
    def reader(name: str):
        return lambda spark: read_table(spark, folder, name)

    def writer(name: str):
        return lambda df: sink.overwrite_parquet(df, f"{base}/{name}")

    jobs = [CopyJob(name, reader(name), writer(name)) for name in names]
    jobs.append(CopyJob("absent", reader("absent"), writer("absent")))
    jobs.append(CopyJob("no_columns", lambda spark: read_table(spark, folder, "region").select(), writer("none")))
    def untyped(spark: SparkSession) -> DataFrame:
        return fixtures.untyped_events(fixtures.events(spark, folder))

    lenient = ErrorBudget(records=None, share=1.0)
    jobs.append(CopyJob("events_strict", untyped, writer("events_strict"), LOAD_FIELDS))
    jobs.append(
        CopyJob("events_lenient", untyped, writer("events_lenient"), LOAD_FIELDS, budget=lenient,
                write_rejects=writer("events_rejects"), stage=f"{base}/events_stage")
    )
    return jobs


def load_audit(spark: SparkSession, folder: str) -> DataFrame:
    audit = copy_many(spark, _copy_jobs(folder, scratch_path(spark, "copies"), TABLES))
    return audit.select("table_name", "status", "rows_in", "rows_out", "rejected")


def load_tally(spark: SparkSession, folder: str) -> DataFrame:
    return tally(copy_many(spark, _copy_jobs(folder, scratch_path(spark, "copies"), TABLES)))


DICTIONARY = [
    {"column_name": "O_ID", "column_type": "bigint(20)", "is_nullable": "NO"},
    {"column_name": "O_NAME", "column_type": "varchar(15)"},
    {"column_name": "O_STATUS", "column_type": "enum('F','O')"},
]


def gated_copy(spark: SparkSession, folder: str) -> DataFrame:
    """Orders copied under a dictionary's rules: repeated keys, long names and unknown states are rejects, the rest arrives."""
    base = scratch_path(spark, "gated")
    key = F.when(F.col("o_orderkey") % 20 == 0, F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey"))

    marks = F.repeat(F.lit("!"), (F.col("o_orderkey") % 9).cast("int"))
    name = F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), marks)

    def read(session: SparkSession) -> DataFrame:
        return read_table(session, folder, "orders").select(
            key.alias("O_ID"), name.alias("O_NAME"), F.col("o_orderstatus").alias("O_STATUS")
        )

    job = CopyJob(
        "orders", read, lambda df: sink.overwrite_parquet(df, f"{base}/rows"), fields_from_metadata(DICTIONARY),
        keys=(KeySpec("PRIMARY", ("o_id",), primary=True),), budget=ErrorBudget(records=None, share=1.0),
        write_rejects=lambda df: sink.overwrite_parquet(df, f"{base}/rejects"), stage=f"{base}/stage",
    )
    copy_table(spark, job)
    good = spark.read.parquet(f"{base}/rows").withColumn("reasons", F.lit(""))
    bad = spark.read.parquet(f"{base}/rejects").withColumn("reasons", F.array_join(REASONS, ",")).drop(REASONS)
    return good.unionByName(bad)


# --- messages and changes --------------------------------------------------------------------

def delimited_parse(spark: SparkSession, folder: str) -> DataFrame:
    lines = parse_lines(fixtures.delimited_lines(fixtures.events(spark, folder)))
    return lines.select("event_id", "name", "age", "rejected")


ORDER_LINE = (("order_no", "bigint"), ("day", "date"), ("total", fixtures.MONEY))


def delimited_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of another declared schema: three typed fields and another delimiter."""
    return parse_lines(fixtures.order_lines(spark, folder), "|", ORDER_LINE).drop("value")


def stream_delimited_append(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "lines")
    lines = fixtures.delimited_lines(fixtures.event_stream(spark, folder))
    append_lines(lines, f"{base}/rows", f"{base}/_checkpoint").awaitTermination()
    return read_lines(spark, f"{base}/rows").select("event_id", "name", "age")


def _normalised(spark: SparkSession, folder: str) -> DataFrame:
    feed = fixtures.raw_feed(fixtures.events(spark, folder))
    return normalise_changes(feed, databases=["shop"], tables=["accounts"])


def cdc_normalise(spark: SparkSession, folder: str) -> DataFrame:
    return _normalised(spark, folder).select(
        "op", "db", "tbl", "seq", "row_no",
        F.col("old.user_id").alias("old_user_id"), F.col("old.amount").alias("old_amount"),
        F.col("new.user_id").alias("new_user_id"), F.col("new.amount").alias("new_amount"),
    )


def change_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return alerts(_normalised(spark, folder))


def alerts_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of rows with NULL fields, which stay in the text, and of events without rows."""
    return alerts(normalise_changes(fixtures.moving_feed(fixtures.events(spark, folder)), tables=["accounts"]))


def stream_change_alerts(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "alerts")
    feed = fixtures.raw_feed(fixtures.event_stream(spark, folder))
    append_alerts(feed, f"{base}/rows", f"{base}/_checkpoint", ["shop"], ["accounts"]).awaitTermination()
    return spark.read.schema(
        "event_type string, db string, tbl string, seq bigint, row_no int, data string"
    ).json(f"{base}/rows")


def stream_insert_append(spark: SparkSession, folder: str) -> DataFrame:
    """Append mode: the inserted rows of a change stream, each once."""
    base = scratch_path(spark, "inserts")
    changes = fixtures.change_log(fixtures.event_stream(spark, folder))
    append_inserts(changes, f"{base}/rows", f"{base}/_checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/rows").drop("op")


def cdc_latest_state(spark: SparkSession, folder: str) -> DataFrame:
    changes = fixtures.change_log(fixtures.events(spark, folder))
    return latest_state(changes, USER_KEY, EVENT_ORDER).drop("op")


def cdc_snapshot_plus_changes(spark: SparkSession, folder: str) -> DataFrame:
    changes = fixtures.change_log(fixtures.events(spark, folder))
    everything = fixtures.customer_snapshot(spark, folder).unionByName(changes)
    return latest_state(everything, USER_KEY, EVENT_ORDER).drop("op")


def stream_cdc_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """A change stream in several micro-batches, folded into a base, then read."""
    root = scratch_path(spark, "state")
    changes = fixtures.change_log(fixtures.event_batches(spark, folder, f"{root}-feed"))
    upsert_stream(changes, root, USER_KEY, EVENT_ORDER).awaitTermination()
    compact(spark, root, USER_KEY, EVENT_ORDER)
    return current_rows(spark, root, USER_KEY, EVENT_ORDER).drop("op")


def stream_feed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """A raw feed into a table by key, in several micro-batches; an update that moves a row deletes it under its old key."""
    root = scratch_path(spark, "feed")
    feed = fixtures.feed_batches(spark, folder, f"{root}-feed")
    upsert_feed(feed, root, USER_KEY, ["shop"], ["accounts"]).awaitTermination()
    return current_rows(spark, root, USER_KEY, FEED_ORDER).drop("op")


def stream_cdc_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The first full copy as the base of the table, then the change stream on top."""
    root = scratch_path(spark, "state")
    load_snapshot(fixtures.customer_snapshot(spark, folder), root)
    changes = fixtures.change_log(fixtures.event_stream(spark, folder))
    upsert_stream(changes, root, USER_KEY, EVENT_ORDER).awaitTermination()
    return current_rows(spark, root, USER_KEY, EVENT_ORDER).drop("op")


QUERIES = {
    "daily_order_summary": daily_order_summary,
    "dwd_orders": dwd_orders,
    "row_count": row_count,
    "sql_steps": sql_steps,
    "range_split_read": range_split_read,
    "column_read": column_read,
    "incremental_load": incremental_rows,
    "incremental_mark": incremental_mark,
    "incremental_null_marks": incremental_null_marks,
    "table_append": table_append,
    "truncate_load": truncate_load,
    "text_overwrite": text_overwrite,
    "text_linefeeds": text_linefeeds,
    "orc_append": orc_append,
    "partitioned_bucketed_load": partitioned_bucketed_load,
    "partition_overwrite": partition_overwrite,
    "retention_30d": retention_30d,
    "column_inventory": inventory,
    "exclude_list": exclude_list,
    "exclude_table": exclude_table,
    "ordered_list_per_group": ordered_list_per_group,
    "text_scrub": text_scrub,
    "type_lookup": type_lookup,
    "distinct_chars": distinct_letters,
    "conform_types": conform_types,
    "conform_types_reference": conform_types_reference,
    "conform_lossless_numbers": conform_lossless_numbers,
    "not_null_violations": not_null_violations,
    "domain_violations": domain_violations,
    "length_violations": length_violations,
    "key_violations": primary_key_violations,
    "unique_violations": unique_key_violations,
    "key_report": key_summary,
    "default_fill": default_fill,
    "error_budget": error_budget,
    "load_audit": load_audit,
    "load_tally": load_tally,
    "gated_copy": gated_copy,
    "delimited_parse": delimited_parse,
    "delimited_orders": delimited_orders,
    "stream_delimited_append": stream_delimited_append,
    "cdc_normalise": cdc_normalise,
    "change_alerts": change_alerts,
    "alerts_with_nulls": alerts_with_nulls,
    "stream_change_alerts": stream_change_alerts,
    "stream_insert_append": stream_insert_append,
    "cdc_latest_state": cdc_latest_state,
    "cdc_snapshot_plus_changes": cdc_snapshot_plus_changes,
    "stream_cdc_upsert": stream_cdc_upsert,
    "stream_cdc_snapshot": stream_cdc_snapshot,
    "stream_feed_upsert": stream_feed_upsert,
}
