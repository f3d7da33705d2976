"""The test tables in the shapes of loads that go on: keys, change feeds, versions, dictionaries; all derived by Spark from the given tables."""

from __future__ import annotations

import itertools
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.plans.fixtures import MONEY, customer_snapshot, events, ods_orders, type_strings
from odsflow.sources.tables import read_table

CUT = "1996-01-01 00:00:00"


def orders_with_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which one in 25 bears the key of some other order, and one in 501 none."""
    own = F.col("id")
    other = F.when(own % 25 == 0, own % 1000 + 1).otherwise(own)
    return ods_orders(spark, folder).withColumn("id", F.when(own % 501 != 0, other)).select("id", "order_time", "order_amount")


class MovingTable:
    """A table keyed by user that goes on changing: customers at first, then the events, one position each.

    Every call moves the clock on by `step` positions; `read` shows the rows as they are then.
    """

    def __init__(self, spark: SparkSession, folder: str, step: int):
        self.before, self.log = customer_snapshot(spark, folder), events(spark, folder)
        self.step, self.clock, self.lock = step, itertools.count(1), threading.Lock()

    def position(self) -> int:
        with self.lock:
            return next(self.clock) * self.step

    def read(self, predicate: str) -> DataFrame:
        now = self.position()
        came = self.log.filter(F.col("event_id") <= now).select("user_id", "event_id", "event_type", "ts", "value")
        first = self.before.select("user_id", "event_id", F.lit("signup").alias("event_type"), "ts", "value")
        rows = first.unionByName(came).groupBy("user_id").agg(F.max_by(F.struct("event_type", "ts", "value"), "event_id").alias("row"))
        return rows.filter("row.event_type <> 'error'").select("user_id", "row.ts", "row.value").filter(predicate)


def position_log(events: DataFrame) -> DataFrame:
    """Events as changes of the moving table; the event's number is its position."""
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return events.select(op.alias("op"), F.col("event_id").alias("seq"), "user_id", "ts", "value")


def order_feed(spark: SparkSession, folder: str) -> DataFrame:
    """A raw feed that makes the orders: each is inserted, one in 4 updated (one in 8 to another day), one in 10 deleted; one event in 7 comes twice.

    `delivery` says which of several batches brings the event.
    """
    def image(amount, status, time):
        return F.struct(F.col("id").alias("id"), amount.cast(MONEY).alias("order_amount"), status.alias("order_status"), time.alias("order_time"))

    amount, status, time, key = (F.col(c) for c in ("order_amount", "order_status", "order_time", "id"))
    first = image(amount, status, time)
    later = image(amount + 10, F.when(key % 12 == 0, F.lit("F")).otherwise(status), F.when(key % 8 == 0, F.timestamp_add("DAY", F.lit(1), time)).otherwise(time))
    last = F.when(key % 4 == 0, later).otherwise(first)
    nothing = F.lit(None)

    def event(number: int, kind: str, values, before, after):
        row = F.struct(values.cast(ROW).alias("values"), before.cast(ROW).alias("before_values"), after.cast(ROW).alias("after_values"))
        return F.struct((key * 4 + number).alias("seq"), F.lit(kind).alias("kind"), F.array(row).alias("rows"))

    events_ = F.array_compact(F.array(
        event(0, "insert", first, nothing, nothing),
        F.when(key % 4 == 0, event(1, "update", nothing, first, later)),
        F.when(key % 10 == 0, event(2, "delete", last, nothing, nothing)),
    ))
    rows = ods_orders(spark, folder).select(F.explode(events_).alias("e")).select("e.*")
    copies = F.when(F.col("seq") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).select(
        "kind", F.lit("shop").alias("db"), F.lit("orders").alias("tbl"), "seq", "rows", F.pmod(F.hash("seq", "copy"), F.lit(1000)).alias("delivery")
    )


ROW = f"struct<id: bigint, order_amount: {MONEY}, order_status: string, order_time: timestamp_ntz>"


def order_feed_batches(spark: SparkSession, folder: str, target: str, files: int = 4) -> DataFrame:
    """The order feed as a stream of several micro-batches."""
    feed = order_feed(spark, folder)
    feed.repartition(files, "delivery").write.parquet(target)
    return spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(target)


def holed_feed(events: DataFrame) -> DataFrame:
    """Events of several log files by position; some runs are dropped, some events come two or three times."""
    number = F.col("event_id")
    times = F.when(number % 97 < 3, 0).when(number % 89 < 2, 2).when(number % 1009 == 5, 3).otherwise(1)
    return events.select(
        F.concat(F.lit("log-"), F.floor(number / 2500).cast("string")).alias("file"), number.alias("seq"), F.explode(F.array_repeat(F.lit(1), times)).alias("one")
    ).drop("one")


def lineitem_versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Line items, and a later version: some orders gone, some lines changed, some lines added."""
    old = read_table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"])
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    kept = old.filter(order % 997 != 0).withColumn("l_quantity", F.when((order % 991 == 0) & (line == 1), F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    extra = old.filter((order % 983 == 0) & (line == 1)).withColumn("l_linenumber", (line + 100).cast(old.schema["l_linenumber"].dataType))
    return old, kept.unionByName(extra)


def dictionary(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parts as a data dictionary (tables, columns, indexes): three schemas with tables of the same names, some of them views."""
    number = F.col("p_partkey")
    place = read_table(spark, folder, "part").select(
        number, F.element_at(F.array(F.lit("Shop"), F.lit("crm"), F.lit("Archive")), (number % 3 + 1).cast("int")).alias("table_schema"),
        F.concat(F.lit("T_"), F.floor(number / 12).cast("string")).alias("table_name"), F.floor(number / 12).alias("no"),
        (number % 12 + 1).cast("int").alias("ordinal_position"), "p_name",
    )
    columns = place.join(type_strings(spark, folder), "p_partkey").select(
        "table_schema", "table_name", "ordinal_position", F.concat(F.lit("C"), F.col("ordinal_position").cast("string")).alias("column_name"),
        F.regexp_extract("mysql_type", "^[A-Za-z]+", 0).alias("data_type"), F.col("mysql_type").alias("column_type"),
        F.when(number % 4 == 0, "NO").otherwise("YES").alias("is_nullable"), F.lit(None).cast("string").alias("column_default"),
        F.col("p_name").alias("column_comment"),
    )
    kind = F.when(F.max("no") % 5 == 0, "VIEW").otherwise("BASE TABLE")
    tables = place.groupBy("table_schema", "table_name").agg(kind.alias("table_type"), F.lit("it's a table").alias("table_comment"))
    step = F.col("ordinal_position")
    name = F.when(step <= 3, "PRIMARY").when(step <= 9, "uk_late").otherwise("plain")
    indexes = place.select(
        "table_schema", "table_name", name.alias("index_name"), F.when(name == "plain", 1).otherwise(0).alias("non_unique"),
        (F.lit(20) - step).alias("seq_in_index"), F.concat(F.lit("C"), step.cast("string")).alias("column_name"),
    )
    return tables, columns, indexes


def oracle_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as an Oracle client hands them over: numbers as text, some too long for their column or with more places."""
    order, price = F.col("l_orderkey"), F.col("l_extendedprice").cast("decimal(12,2)")
    more = F.concat(price.cast("string"), F.lit("5"))
    return read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        F.when(order % 30 == 0, "99999999999").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("QTY"),
        F.when(order % 30 == 1, more).when(order % 30 == 2, "n/a").otherwise(price.cast("string")).alias("PRICE"),
        F.when(order % 30 == 3, "0.12345678901").when(order % 30 != 4, F.col("l_discount").cast("decimal(4,2)").cast("string")).alias("RATE"),
    )


def dated_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items by ship day, of which a third lies on one day and one in 60 has none."""
    order = F.col("l_orderkey")
    day = F.when(order % 60 == 7, F.lit(None)).when(order % 3 == 0, F.lit("1996-02-29").cast("date")).otherwise(F.col("l_shipdate").cast("date"))
    return read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", day.alias("ship_day"))


def positioned_batches(spark: SparkSession, folder: str, target: str, files: int = 5) -> DataFrame:
    """Events in the order of their numbers, as a stream of one file per micro-batch."""
    rows = events(spark, folder)
    bounds = rows.agg(F.min("event_id"), F.max("event_id")).first()
    width = max(1, -(-(bounds[1] - bounds[0] + 1) // files))
    for i in range(files):
        first = bounds[0] + i * width
        rows.filter((F.col("event_id") >= first) & (F.col("event_id") < first + width)).coalesce(1).write.mode("append").parquet(target)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(target)


def lines_by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    """Line items by supplier; one supplier has a third of them."""
    hot = F.when(F.col("l_orderkey") % 3 == 0, 7).otherwise(F.col("l_suppkey")).cast("long")
    return read_table(spark, folder, "lineitem").select(hot.alias("supplier"), "l_orderkey", "l_linenumber", "l_quantity")
