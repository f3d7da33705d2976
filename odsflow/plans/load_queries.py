"""Queries over loads that go on: keys across loads, chunked copies, summaries from changes, digests, feed positions, dictionaries."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.functions.ranges import slices_of, sorted_cuts, tuple_predicates
from odsflow.operators.changes import normalise_changes
from odsflow.operators.conform import conform, fields_from_metadata
from odsflow.operators.digests import Ranges, compare_versions, write_tree
from odsflow.operators.positions import boundaries, fold_seen, gaps_and_repeats, mark_seen, runs, seen
from odsflow.operators.quality import REASONS, ErrorBudget, KeySpec
from odsflow.plans import fixtures, load_fixtures
from odsflow.plans.dictionary import copy_plan
from odsflow.plans.jobs import CopyJob, Incremental, copy_table
from odsflow.session import scratch_path
from odsflow.sinks import clustered, tables as sink
from odsflow.sources.incremental import slice_writer
from odsflow.streaming import chunks, summaries
from odsflow.streaming.budget import budgeted_stream, good_rows, totals
from odsflow.streaming.delimited import parse_lines
from odsflow.streaming.flush import FLUSHES, count_or_time_flush
from odsflow.streaming.upsert import upsert_stream

USER_KEY = ["user_id"]


def keys_across_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in two incremental loads: a key repeated in a load, or brought by the earlier one, is a reject; `load_no` says which load had the row."""
    orders = load_fixtures.orders_with_repeated_keys(spark, folder)
    base = scratch_path(spark, "keyed")
    early = orders.filter(F.col("order_time") < F.lit(load_fixtures.CUT).cast("timestamp_ntz"))
    for number, available in enumerate((early, orders), 1):
        copy_table(spark, CopyJob(
            "orders", lambda session, df=available: df, slice_writer(f"{base}/rows"), keys=(KeySpec("PRIMARY", ("id",), primary=True),),
            budget=ErrorBudget(records=None, share=1.0), write_rejects=lambda df, n=number: sink.overwrite_parquet(df, f"{base}/rejects/load_no={n}"),
            stage=f"{base}/stage", incremental=Incremental("order_time", f"{base}/marks"), key_index=f"{base}/index",
        ))
    loaded = spark.read.parquet(f"{base}/rows")
    first = F.when(F.col("loaded_after") == "initial", 1).otherwise(2).alias("load_no")
    good = loaded.select("id", "order_time", "order_amount", first, F.lit("").alias("reasons"))
    rejects = spark.read.parquet(f"{base}/rejects")
    return good.unionByName(rejects.select("id", "order_time", "order_amount", "load_no", F.array_join(REASONS, ",").alias("reasons")))


CHUNKS = 6


def cdc_chunked_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """A table copied in key chunks while it changes, half of them before and half behind the log's batches; then the table as the log leaves it."""
    root = scratch_path(spark, "chunked")
    log = fixtures.events(spark, folder)
    table = load_fixtures.MovingTable(spark, folder, max(1, log.count() // (3 * CHUNKS + 1)))
    keys = table.before.select("user_id")
    predicates = chunks.chunk_predicates(keys, "user_id", CHUNKS, 1)
    chunks.copy_chunks(spark, predicates, table.read, table.position, root, only=list(range(0, len(predicates), 2)))
    changes = load_fixtures.position_log(fixtures.event_batches(spark, folder, f"{root}-feed"))
    upsert_stream(chunks.log_changes(changes), root, USER_KEY, chunks.ORDER).awaitTermination()
    chunks.copy_chunks(spark, predicates, table.read, table.position, root)
    return chunks.current_rows(spark, root, USER_KEY).select("user_id", "ts", "value")


DAILY = summaries.Summary(
    group={"order_date": "CAST(order_time AS DATE)"},
    sums={"total_amount": "order_amount", "success_order_cnt": "CASE WHEN order_status = 'F' THEN 1 ELSE 0 END"},
    unit="date_format(order_time, 'yyyy-MM')", where="order_amount > 0",
)


def daily_summary_from_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The daily order summary, kept up from a change feed in several batches that deliver some events twice; no batch rereads the orders."""
    root = scratch_path(spark, "upkeep")
    feed = load_fixtures.order_feed_batches(spark, folder, f"{root}-feed")
    summaries.summarise_feed(feed, root, DAILY, ["shop"], ["orders"]).awaitTermination()
    kept = summaries.current_summary(spark, root, summaries.deltas(normalise_changes(load_fixtures.order_feed(spark, folder)), DAILY).schema)
    return kept.select("order_date", F.col(summaries.COUNT).alias("order_cnt"), F.col("total_amount").cast("decimal(28,2)").alias("total_amount"), "success_order_cnt")


LINE_RANGES = Ranges("l_orderkey", 64, ("l_orderkey", "l_linenumber"))


def range_digest_diff(spark: SparkSession, folder: str) -> DataFrame:
    """The lines inserted, changed and deleted between two stored versions, found through their digest trees."""
    base = scratch_path(spark, "versions")
    stored, tops = [], []
    for name, version in zip(("old", "new"), load_fixtures.lineitem_versions(spark, folder)):
        version.repartitionByRange("l_orderkey").sortWithinPartitions("l_orderkey").write.parquet(f"{base}/{name}")
        stored.append(spark.read.schema(version.schema).parquet(f"{base}/{name}"))
        tops.append(write_tree(stored[-1], LINE_RANGES, f"{base}/{name}-tree"))
    return compare_versions(*stored, LINE_RANGES, f"{base}/old-tree", f"{base}/new-tree", tuple(tops))


def feed_position_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Positions that a feed of several log files left out or brought more than once, as ranges."""
    feed = load_fixtures.holed_feed(fixtures.events(spark, folder))
    return gaps_and_repeats(runs(boundaries(feed, "seq", F.col("file"))))


def stream_position_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a stream: each batch stores what it brought, the report adds the batches up (some of them folded before)."""
    root = scratch_path(spark, "positions")
    feed = load_fixtures.holed_feed(fixtures.event_batches(spark, folder, f"{root}/feed"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        mark_seen(batch, "seq", f"{root}/seen", batch_id, F.col("file"))
        if batch_id == 2:
            fold_seen(batch.sparkSession, f"{root}/seen")

    feed.writeStream.foreachBatch(apply).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return gaps_and_repeats(runs(seen(spark, f"{root}/seen")))


def dictionary_copy_plan(spark: SparkSession, folder: str) -> DataFrame:
    """What is to be copied by a data dictionary: per base table its columns with their types in order, and its keys."""
    plan = copy_plan(*load_fixtures.dictionary(spark, folder), exclude=["t_3"])
    column = F.transform("columns", lambda c: F.concat_ws(" ", c["column_name"], c["column_type"], c["nullable"].cast("string")))
    key = F.transform("keys", lambda k: F.concat(k["name"], F.lit("("), F.array_join(k["columns"], ","), F.lit(")")))
    return plan.select("table_schema", "table_name", "comment", F.array_join(column, "; ").alias("columns"), F.array_join(key, " ").alias("keys"))


ORACLE_COLUMNS = [
    {"column_name": "QTY", "column_type": "NUMBER", "data_precision": 5, "data_scale": 0, "is_nullable": "N"},
    {"column_name": "PRICE", "column_type": "NUMBER", "data_precision": 12, "data_scale": 2},
    {"column_name": "RATE", "column_type": "NUMBER"},
]


def conform_oracle_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Oracle NUMBER columns by their precision and scale; one without gets 10 places. What a column cannot hold unchanged is named."""
    lines = load_fixtures.oracle_lines(spark, folder)
    fields = fields_from_metadata(ORACLE_COLUMNS, "oracle", "lossless")
    own = [f for f in fields_from_metadata([{"column_name": c, "column_type": "NUMBER", "data_precision": 18, "data_scale": 0}
                                            for c in ("l_orderkey", "l_linenumber")], "oracle")]
    checked = conform(lines, own + fields)
    return checked.select("l_orderkey", "l_linenumber", "qty", "price", "rate", F.array_join(REASONS, ",").alias("reasons"))


def composite_split_read(spark: SparkSession, folder: str) -> DataFrame:
    """Line items dealt to the slices of (day, order, line): every row lies in exactly one, also on the day that a third of them share, or without a day."""
    lines = load_fixtures.dated_lines(spark, folder)
    columns = ["ship_day", "l_orderkey", "l_linenumber"]
    predicates = tuple_predicates(columns, sorted_cuts(lines, columns, 8))
    return lines.withColumn("slice_no", F.explode(slices_of(predicates))).drop("slice_no")


def stream_error_budget(spark: SparkSession, folder: str) -> DataFrame:
    """Lines in several micro-batches under a budget of 120 bad ones: how many were taken until the line that breaks it, and which that is."""
    root = scratch_path(spark, "budget")
    lines = parse_lines(fixtures.delimited_lines(load_fixtures.positioned_batches(spark, folder, f"{root}-feed")))
    reason = F.when(F.col("rejected"), F.array(F.lit("line"))).otherwise(F.array().cast("array<string>"))
    query = budgeted_stream(lines.withColumn(REASONS, reason), root, "event_id", ErrorBudget(records=120, share=None))
    try:
        query.awaitTermination()
    except StreamingQueryException as stopped:
        if "BudgetExceeded" not in str(stopped):
            raise
    found = totals(spark, root)
    return good_rows(spark, root).agg(F.count(F.lit(1)).alias("good_rows")).withColumns({
        name: F.lit(value).cast("long") for name, value in (("total_rows", found.total), ("bad_rows", found.bad), ("stopped_at", found.stopped_at))
    })


def range_clustered_load(spark: SparkSession, folder: str) -> DataFrame:
    """Line items clustered by supplier, a hot one cut by its orders; the suppliers 5 to 9 are read from the files that can hold them."""
    path = f"{scratch_path(spark, 'clustered')}/lines"
    lines = load_fixtures.lines_by_supplier(spark, folder)
    clustered.save_clustered(lines, path, ["supplier", "l_orderkey", "l_linenumber"], rows_per_file=5000)
    return clustered.read_between(spark, path, "supplier", 5, 9)


def stream_count_or_time_flush(spark: SparkSession, folder: str) -> DataFrame:
    """Events held back by type and handed on as soon as 20 are there or the first is 12 hours old, from several micro-batches."""
    root = scratch_path(spark, "flush")
    events = load_fixtures.positioned_batches(spark, folder, f"{root}-feed")
    flushes = count_or_time_flush(events, F.col("event_type"), F.lpad(F.col("event_id").cast("string"), 12, "0"), "ts", rows=20, seconds=12 * 3600)
    flushes.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/rows").awaitTermination()
    return spark.read.schema(FLUSHES).parquet(f"{root}/rows")


QUERIES = {
    query.__name__: query
    for query in (
        keys_across_loads, cdc_chunked_snapshot, daily_summary_from_changes, range_digest_diff, feed_position_gaps,
        stream_position_gaps, dictionary_copy_plan, conform_oracle_numbers, composite_split_read, stream_error_budget,
        range_clustered_load, stream_count_or_time_flush,
    )
}
