"""The test tables in the shapes the jobs expect; all derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.sources.tables import read_table, stream_table

MONEY = "decimal(18,2)"
EVENT_FILES = 5
FILES_PER_TRIGGER = 1000  # bounds a micro-batch while a long history is read for the first time


def ods_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as id, user, amount, status, time."""
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast(MONEY).alias("order_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("order_time"),
    )


def delimited_lines(events: DataFrame) -> DataFrame:
    """`name#age` lines: of every 50, one lacks a field, one has a bad number, one a field too many."""
    kind, user = F.col("event_id") % 50, F.col("user_id").cast("string")
    name = F.col("event_type")
    return events.select(
        "event_id",
        F.when(kind == 0, name)
        .when(kind == 1, F.concat_ws("#", name, F.lit("x")))
        .when(kind == 2, F.concat_ws("#", name, user, F.lit("extra")))
        .otherwise(F.concat_ws("#", name, user))
        .alias("value"),
    )


def untyped_events(events: DataFrame) -> DataFrame:
    """Event columns as text, with bad, oversized and missing numbers and one bad date in 40."""
    kind = F.col("event_id") % 40
    return events.select(
        "event_id",
        F.col("value").cast("string").alias("s_val"),
        F.when(kind == 0, "abc")
        .when(kind == 1, "99999999999")
        .when(kind != 2, F.col("user_id").cast("string"))
        .alias("s_int"),
        F.when(kind == 3, "2024-13-01").otherwise(F.col("ts").cast("date").cast("string")).alias("s_date"),
    )


def change_log(events: DataFrame) -> DataFrame:
    """Events as changes of a table keyed by user, ordered by (ts, event_id)."""
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return events.select(op.alias("op"), "ts", "event_id", "user_id", "value")


def customer_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as the first full copy of the table that `change_log` changes."""
    return read_table(spark, folder, "customer").select(
        F.lit("I").alias("op"),
        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.lit(-1).cast("bigint").alias("event_id"),
        F.col("c_custkey").alias("user_id"),
        F.col("c_acctbal").alias("value"),
    )


def raw_feed(events: DataFrame) -> DataFrame:
    """Events as a raw change feed of two databases; a purchase touches two rows, clicks are not row changes."""
    name = F.col("event_type")
    kind = (
        F.when(name == "signup", "insert").when(name == "error", "delete").when(name == "click", "ddl")
        .otherwise("update")
    )
    prepared = events.select(
        "event_id", "user_id", kind.alias("kind"), (name == "purchase").alias("two_rows"),
        F.col("value").cast(MONEY).alias("amount"),
    )
    updated = F.col("kind") == "update"

    def row(user_shift: int, amount_shift: int):
        amount = (F.col("amount") + F.lit(amount_shift)).cast(MONEY) if amount_shift else F.col("amount")
        return F.struct((F.col("user_id") + user_shift).alias("user_id"), amount.alias("amount"))

    def change(shift: int):
        return F.struct(
            F.when(~updated, row(shift, 0)).alias("values"),
            F.when(updated, row(shift, -1)).alias("before_values"),
            F.when(updated, row(shift, 0)).alias("after_values"),
        )

    return prepared.select(
        "kind",
        F.when(F.col("user_id") % 10 == 0, "archive").otherwise("shop").alias("db"),
        F.lit("accounts").alias("tbl"),
        F.col("event_id").alias("seq"),
        F.when(F.col("two_rows"), F.array(change(0), change(100000))).otherwise(F.array(change(0))).alias("rows"),
    )


def type_strings(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as column definitions: a MySQL and an Oracle type text made from key and size."""
    size = F.col("p_size").cast("string")
    mysql, oracle = F.col("p_partkey") % 13, F.col("p_partkey") % 6
    plain = {2: "int(10) unsigned", 3: "TINYINT(1)", 4: "enum('a','b')", 5: "geometry", 6: "timestamp(6)",
             7: "char", 8: "double(10,2)", 9: "longblob", 10: "json", 11: "datetime", 12: "year"}
    precision = (F.col("p_size") % 20 + 10).cast("string")
    scale = (F.col("p_size") % 10).cast("string")
    mysql_type = F.when(mysql == 0, F.concat(F.lit("decimal("), precision, F.lit(", "), scale, F.lit(")"))).when(
        mysql == 1, F.concat(F.lit("varchar("), size, F.lit(")"))
    )
    for number, text in plain.items():
        mysql_type = mysql_type.when(mysql == number, text)
    oracle_type = (
        F.when(oracle == 0, F.concat(F.lit("NUMBER("), (F.col("p_size") % 15 + 5).cast("string"), F.lit(")")))
        .when(oracle == 1, F.concat(F.lit("NUMBER(12,"), (F.col("p_size") % 4).cast("string"), F.lit(")")))
        .when(oracle == 2, "NUMBER")
        .when(oracle == 3, F.concat(F.lit("VARCHAR2("), size, F.lit(")")))
        .when(oracle == 4, "TIMESTAMP(6)")
        .otherwise("DOUBLE PRECISION")
    )
    return read_table(spark, folder, "part").select(
        "p_partkey", mysql_type.alias("mysql_type"), oracle_type.alias("oracle_type")
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events")


def event_batches(spark: SparkSession, folder: str, target: str, files: int = EVENT_FILES) -> DataFrame:
    """Events written as several files and read as a stream of one file per micro-batch."""
    rows = events(spark, folder)
    rows.repartition(files, "event_id").write.parquet(target)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(target)


def feed_batches(spark: SparkSession, folder: str, target: str, files: int = EVENT_FILES) -> DataFrame:
    """The raw feed as a stream of several micro-batches; every third update moves a row to another key."""
    return moving_feed(event_batches(spark, folder, target, files))


def moving_feed(events: DataFrame) -> DataFrame:
    """`raw_feed` of one database in which updates of every third event change the key, and one event in 90 has no rows."""
    moves = F.when(F.col("event_id") % 3 == 0, 1_000_000).otherwise(0)
    kind = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete").otherwise("update")
    amount = F.col("value").cast(MONEY)
    after = F.struct((F.col("user_id") + moves).alias("user_id"), F.when(F.col("event_id") % 4 > 0, amount).alias("amount"))
    before = F.struct(F.col("user_id").alias("user_id"), F.lit(None).cast(MONEY).alias("amount"))
    row = F.struct(
        F.when(kind != "update", F.struct(F.col("user_id").alias("user_id"), amount.alias("amount"))).alias("values"),
        F.when(kind == "update", before).alias("before_values"), F.when(kind == "update", after).alias("after_values"),
    )
    return events.select(
        kind.alias("kind"), F.lit("shop").alias("db"), F.lit("accounts").alias("tbl"), F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 90 != 0, F.array(row)).alias("rows"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as `id|day|total` lines; of every 40, one has a bad day, one an empty total, one a field too many."""
    kind = F.col("o_orderkey") % 40
    key, day = F.col("o_orderkey").cast("string"), F.col("o_orderdate").cast("date").cast("string")
    total = F.col("o_totalprice").cast(MONEY).cast("string")
    value = (
        F.when(kind == 0, F.concat_ws("|", key, F.lit("1999-02-30"), total)).when(kind == 1, F.concat_ws("|", key, day, F.lit("")))
        .when(kind == 2, F.concat_ws("|", key, day, total, F.lit("more"))).otherwise(F.concat_ws("|", key, day, total))
    )
    return read_table(spark, folder, "orders").select("o_orderkey", value.alias("value"))


def wide_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with whole numbers beyond a double's 53 bits, times of day, and text dates with a time."""
    shift = F.when(F.col("o_orderkey") % 2 == 0, 9007199254740992).otherwise(0).cast("bigint")
    hours = F.col("o_orderkey") % 3
    stamp = F.timestamp_add("HOUR", hours.cast("int"), F.col("o_orderdate"))
    return read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_orderkey") + shift).alias("big"), stamp.alias("stamp"),
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("day_text"),
    )


def unmarked_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which one in 50 has no time."""
    time = F.when(F.col("id") % 50 != 0, F.col("order_time"))
    return ods_orders(spark, folder).withColumn("order_time", time)


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return stream_table(spark, folder, "events", FILES_PER_TRIGGER)
