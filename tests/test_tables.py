import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from odsflow.operators.conform import Field, fields_from_metadata
from odsflow.operators.metadata import catalog_columns, column_inventory, exclude_names, ordered_columns, tidy_columns
from odsflow.operators.quality import REASONS, ErrorBudget, KeySpec, not_null
from odsflow.plans.config import read_source, run_copies, run_etl, start_stream
from odsflow.plans.jobs import (
    CopyJob, Incremental, copy_many, copy_table, create_tables, jobs_from_columns, tally,
)
from odsflow.plans.steps import read_steps, run_steps
from odsflow.session import scratch_path, shared_folder
from odsflow.sinks import tables as sink
from odsflow.sources.incremental import incremental_load, read_mark, slice_writer, store_mark, unmarked_writer
from odsflow.sources.tables import read_table, read_text_table, stream_table
from odsflow.streaming.delimited import append_lines, read_lines
from odsflow.streaming.triggers import trigger_options
from odsflow.streaming.upsert import current_rows

# --- sinks -------------------------------------------------------------------------------------


def test_text_round_trip_with_awkward_fields(spark, tmp_path):
    path, schema = str(tmp_path / "text"), "id int, s string"
    rows = [(1, "a,b"), (2, 'say "hi"'), (3, "two\nlines"), (4, None), (5, "\\N"), (6, "it's"), (7, ""),
            (8, "  both ends "), (9, '""'), (10, "\\"), (11, "a\r\nb\rc")]
    df = spark.createDataFrame(rows, schema)
    for _ in range(2):  # replaced, not appended
        sink.overwrite_text(df, path, max_rows_per_file=2)
    back = read_text_table(spark, path, schema)
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_text_with_another_delimiter(spark, tmp_path):
    df = spark.createDataFrame([(1, "a#b,c")], "id int, s string")
    sink.overwrite_text(df, str(tmp_path / "t"), "#")
    assert tuple(read_text_table(spark, str(tmp_path / "t"), df.schema, "#").first()) == (1, "a#b,c")


def test_orc_is_snappy_and_appends(spark, tmp_path):
    for _ in range(2):
        sink.append_orc(spark.range(5), str(tmp_path / "orc"))
    assert spark.read.orc(str(tmp_path / "orc")).count() == 10
    assert all("snappy" in f.name for f in (tmp_path / "orc").glob("part-*"))


def test_partition_overwrite_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.createDataFrame([(1, "d1"), (2, "d1"), (3, "d2")], "id int, dt string")
    sink.append_partitioned(df, path, ["dt"])
    for _ in range(2):
        sink.overwrite_partitions(spark.createDataFrame([(9, "d1")], "id int, dt string"), path, ["dt"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("id", "dt").collect()) == [(3, "d2"), (9, "d1")]


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "hot")
    df = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("s"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("d"), (F.col("id") % 20).cast("string"))).alias("dt"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1MB")
    try:
        sink.overwrite_partitions(df.repartition(8), path, ["dt"])
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "hot" / "dt=hot").glob("*.parquet"))) > 1
    assert spark.read.parquet(path).count() == 200_000


def test_bucketed_table_groups_by_its_key_without_shuffle(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).cast("string").alias("dt"))
    sink.save_bucketed(df, "bucketed_t", str(tmp_path / "b"), 8, ["id"], ["dt"], ["id"])
    try:
        table = spark.table("bucketed_t")
        plan = table.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert table.count() == 1000
        assert len(list((tmp_path / "b").glob("dt=*"))) == 3
    finally:
        spark.sql("DROP TABLE bucketed_t")


def test_bucket_count_follows_the_rows():
    assert [sink.bucket_count(n) for n in (0, 60_000, 40_000_001)] == [8, 8, 9]
    with pytest.raises(ValueError):
        sink.bucket_count(10**12)


def test_create_if_absent_with_default_and_comment(spark, tmp_path):
    for _ in range(2):
        sink.create_if_absent(
            spark, "made_t", "id BIGINT COMMENT 'the key', kind STRING DEFAULT 'x', dt STRING",
            str(tmp_path / "made"), partition_by=["dt"], comment="it's made",
        )
    try:
        spark.sql("INSERT INTO made_t (id, dt) VALUES (1, 'a')")
        assert tuple(spark.table("made_t").select("id", "kind", "dt").first()) == (1, "x", "a")
        rows = {r["column_name"]: r for r in catalog_columns(spark).filter("table_name = 'made_t'").collect()}
        assert rows["id"]["column_comment"] == "the key" and rows["dt"]["ordinal_position"] == 3
        assert spark.catalog.getTable("made_t").description == "it's made"
    finally:
        spark.sql("DROP TABLE made_t")


def test_text_table_is_created_as_csv(spark, tmp_path):
    sink.create_if_absent(spark, "text_t", "id INT, s STRING", str(tmp_path / "t"), fmt="textfile")
    try:
        spark.sql("INSERT INTO text_t VALUES (1, 'a,b')")
        assert tuple(spark.table("text_t").first()) == (1, "a,b")
    finally:
        spark.sql("DROP TABLE text_t")


def test_retention_reads_and_drops(spark, tmp_path):
    sink.create_if_absent(spark, "kept_t", "id INT, dt STRING", str(tmp_path / "k"), partition_by=["dt"])
    try:
        spark.sql("INSERT INTO kept_t VALUES (1, '2024-01-01'), (2, '2024-01-31'), (3, '2024-02-20')")
        kept = sink.kept_days(spark.table("kept_t"), "dt", dt.date(2024, 3, 1), 30)
        assert sorted(r["id"] for r in kept.collect()) == [2, 3]
        assert sink.drop_expired(spark, "kept_t", "dt", "2024-03-01", 30) == 1
        assert sorted(r["id"] for r in spark.table("kept_t").collect()) == [2, 3]
    finally:
        spark.sql("DROP TABLE kept_t")


def test_retention_with_a_second_partition_column(spark, tmp_path):
    sink.create_if_absent(spark, "kept2_t", "id INT, dt STRING, region STRING", str(tmp_path / "k"),
                          partition_by=["dt", "region"])
    try:
        spark.sql("INSERT INTO kept2_t VALUES (1, '2024-01-01', 'a'), (2, '2024-01-01', 'it''s: /b'), "
                  "(4, '2024-01-01', NULL), (3, '2024-02-20', 'a')")
        assert sink.drop_expired(spark, "kept2_t", "dt", "2024-03-01", 30) == 3
        assert [r["id"] for r in spark.table("kept2_t").collect()] == [3]
    finally:
        spark.sql("DROP TABLE kept2_t")


def test_expired_folders_of_a_path_table_are_deleted(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = [(1, "2024-01-01"), (2, "2024-01-31"), (3, "2024-02-20"), (4, None), (5, "other")]
    sink.append_partitioned(spark.createDataFrame(rows, "id int, dt string"), path, ["dt"])
    assert sink.delete_expired_folders(spark, path, "dt", dt.date(2024, 3, 1), 30) == ["dt=2024-01-01"]
    assert sink.delete_expired_folders(spark, path, "dt", dt.date(2024, 3, 1), 30) == []
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [2, 3, 4, 5]


# --- steps, incremental, copies ----------------------------------------------------------------


def test_steps_from_a_file(spark, tmp_path):
    path = tmp_path / "steps.json"
    path.write_text('[{"view": "a1", "sql": "SELECT id FROM src WHERE id > 2"}, '
                    '{"view": "a2", "sql": "SELECT count(*) AS n FROM a1"}]')
    assert run_steps(spark, {"src": spark.range(5)}, read_steps(str(path))).first()["n"] == 2
    with pytest.raises(ValueError):
        run_steps(spark, {}, [])


def test_order_steps_drop_null_amounts_and_count_null_status_as_failure(spark):
    from odsflow.plans.steps import daily_order_steps

    rows = [(1, 1, 10, "SUCCESS"), (2, 1, None, "SUCCESS"), (3, 1, 5, None), (4, 1, 0, "SUCCESS"), (5, 1, -1, "X")]
    orders = spark.createDataFrame(rows, "id int, user_id int, order_amount int, order_status string")
    orders = orders.withColumn("order_time", F.lit("2024-05-01 23:59:59").cast("timestamp_ntz"))
    row = run_steps(spark, {"ods_orders": orders}, daily_order_steps()).collect()
    assert [tuple(r) for r in row] == [(dt.date(2024, 5, 1), 2, 15, 1)]


def test_incremental_loads(spark, tmp_path):
    target, marks = str(tmp_path / "rows"), str(tmp_path / "marks")

    def load(rows):
        df = spark.createDataFrame(rows, "id int, changed int")
        return incremental_load(spark, df, "t", "changed", marks, slice_writer(target))

    first = load([(1, 10), (2, 20), (3, None)])
    assert (first.rows, first.unmarked_rows, first.mark) == (3, 1, "20")
    nothing = load([(1, 10), (2, 20)])
    assert (nothing.rows, nothing.mark) == (0, "20")
    second = load([(1, 10), (2, 20), (4, 9), (5, 30), (6, None)])
    assert (second.rows, second.mark) == (1, "30")  # strictly above the mark; NULL and late rows stay out
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 2, 3, 5]
    assert read_mark(spark, marks, "other", "changed") is None


def test_repeated_load_replaces_its_slice(spark, tmp_path):
    df, target = spark.range(3).withColumnRenamed("id", "changed"), str(tmp_path / "rows")
    for marks in ("lost", "kept"):  # the first mark never got stored
        incremental_load(spark, df, "t", "changed", str(tmp_path / marks), slice_writer(target))
    assert spark.read.parquet(target).count() == 3


FIELDS = [Field("id", "int", required=True), Field("name", "string", length=3)]


def copy_job(spark, path, rows, **options):
    return CopyJob(
        "t", lambda s: s.createDataFrame(rows, "id string, name string"),
        lambda df: sink.overwrite_parquet(df, f"{path}/t"), FIELDS, **options,
    )


@pytest.mark.parametrize("staged", [False, True])
def test_copy_gates_before_it_writes(spark, tmp_path, staged):
    stage = str(tmp_path / "stage") if staged else None
    rows = [("1", "abc"), ("x", "abc"), ("3", "abcd")]
    rejects = []
    strict = copy_job(spark, tmp_path, rows, stage=stage)
    audit = copy_many(spark, [strict]).first()
    assert (audit["status"], audit["rows_in"], audit["rejected"]) == ("failed", 3, 2)
    assert not (tmp_path / "t").exists() and not (tmp_path / "stage").exists()
    lenient = copy_job(spark, tmp_path, rows, stage=stage, budget=ErrorBudget(2, None),
                       write_rejects=lambda df: rejects.extend(df.collect()))
    result = copy_table(spark, lenient)
    assert (result.status, result.rows_in, result.rows_out, result.rejected) == ("success", 3, 1, 2)
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [(1, "abc")]
    assert len(rejects) == 2 and not (tmp_path / "stage").exists()


def test_staged_copy_reads_its_source_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    job = CopyJob("t", lambda s: s.range(10).mapInPandas(noted, "id bigint"),
                  lambda df: sink.overwrite_parquet(df, str(tmp_path / "t")),
                  rules=(not_null("id"),), stage=str(tmp_path / "stage"))
    assert copy_table(spark, job).rows_out == 10
    assert reads.value == 10


def test_one_failure_does_not_stop_the_rest(spark, tmp_path, folder):
    def job(name, read=None):
        return CopyJob(name, read or (lambda s: read_table(s, folder, name)),
                       lambda df: sink.overwrite_parquet(df, str(tmp_path / name)))

    def silent(session):
        raise RuntimeError

    assert copy_many(spark, [job("silent", silent)]).first()["error"] == "RuntimeError"
    audit = copy_many(spark, [job("absent"), job("region"), job("empty", lambda s: s.range(0).select()), job("nation")])
    status = {r["table_name"]: r["status"] for r in audit.collect()}
    assert status == {"absent": "failed", "region": "success", "empty": "skipped", "nation": "success"}
    assert {r["status"]: r["table_cnt"] for r in tally(audit).collect()} == {"failed": 1, "success": 2, "skipped": 1}
    assert "absent" in audit.filter("status = 'failed'").first()["error"]


# --- metadata ----------------------------------------------------------------------------------

COLUMNS = (
    "table_schema string, table_name string, ordinal_position int, column_name string, data_type string, "
    "column_type string, is_nullable string, column_default string, column_comment string"
)


@pytest.fixture
def dictionary(spark):
    columns = spark.createDataFrame(
        [
            ("ods", "Users", 2, "Name", "varchar", "varchar(20)", "YES", "none", "it's\nhers"),
            ("ods", "Users", 1, "ID", "int", "int(10) unsigned", "NO", None, None),
            ("ods", "Orders", 1, "id", "bigint", "bigint", "NO", None, ""),
            ("ods", "v_users", 1, "id", "int", "int", "NO", None, ""),
            ("other", "Users", 1, "id", "int", "int", "NO", None, ""),
        ],
        COLUMNS,
    )
    tables = spark.createDataFrame(
        [("ods", "Users", "BASE TABLE"), ("ods", "Orders", "BASE TABLE"), ("ods", "v_users", "VIEW"),
         ("other", "Users", "BASE TABLE")],
        "table_schema string, table_name string, table_type string",
    )
    return columns, tables


def test_tidy_columns(dictionary):
    rows = tidy_columns(*dictionary, "ods").collect()
    assert [(r["table_name"], r["ordinal_position"], r["column_name"], r["is_nullable"]) for r in rows] == [
        ("orders", 1, "id", 0), ("users", 1, "id", 0), ("users", 2, "name", 1),
    ]
    assert rows[2]["column_comment"] == "it\\'s hers" and rows[1]["column_comment"] == ""


def test_jobs_from_the_dictionary(spark, dictionary, tmp_path):
    columns = dictionary[0].filter("table_schema = 'ods'")
    source = spark.createDataFrame([("5", "x"), ("4000000000", None)], "ID string, Name string")
    reader = lambda name: lambda s: source
    writer = lambda name: lambda df: sink.overwrite_parquet(df, str(tmp_path / name))
    jobs = jobs_from_columns(columns, reader, writer, exclude=["V_USERS"])
    assert [j.name for j in jobs] == ["orders", "users"]
    assert [j.name for j in jobs_from_columns(columns, reader, writer, only=["Users"])] == ["users"]
    users = jobs[1]
    assert [(f.name, f.type, f.required) for f in users.fields] == [("id", "bigint", True), ("name", "string", False)]
    assert copy_table(spark, users).rows_out == 2
    assert spark.read.parquet(str(tmp_path / "users")).schema.simpleString() == "struct<id:bigint,name:string>"


def test_exclusion_by_list_and_by_table(spark):
    df = spark.createDataFrame([("a",), ("B",), ("c",), (None,)], "name string")
    assert [r[0] for r in exclude_names(df, "name", ["A", "b"]).collect()] == ["c"]
    listed = spark.createDataFrame([("A",), ("b",), (None,)], "n string")
    assert [r[0] for r in exclude_names(df, "name", listed).collect()] == ["c"]
    assert exclude_names(df, "name", []).count() == 4


def test_ordered_columns_of_indexes(spark):
    rows = [("pk", 0, 2, "b"), ("pk", 0, 1, "a"), ("ix", 1, 1, "c")]
    df = spark.createDataFrame(rows, "index_name string, non_unique int, seq int, column_name string")
    got = {r["index_name"]: r["column_names"] for r in ordered_columns(
        df, ["index_name", "non_unique"], "seq", "column_name").collect()}
    assert got == {"pk": ["a", "b"], "ix": ["c"]}


def test_inventory_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "A int, b string")
    rows = column_inventory({"t": df, "empty": df.limit(0)}).orderBy("table_name", "ordinal_position").collect()
    assert [(r["table_name"], r["column_name"], r["row_cnt"], r["null_cnt"], r["is_nullable"]) for r in rows] == [
        ("empty", "a", 0, 0, 0), ("empty", "b", 0, 0, 0), ("t", "a", 2, 0, 0), ("t", "b", 2, 1, 1),
    ]


# --- streams and session -----------------------------------------------------------------------


def test_line_stream_equals_batch_after_restart(spark, tmp_path):
    feed, out, checkpoint = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    feed.mkdir()
    (feed / "a.txt").write_text("ann#31\nbob#x\nbob#7\n")
    lines = lambda: spark.readStream.option("maxFilesPerTrigger", 1).text(str(feed))
    append_lines(lines(), out, checkpoint).awaitTermination()
    (feed / "b.txt").write_text("eve#5#6\nzoe#9\n")
    for _ in range(2):  # the second start finds nothing new
        append_lines(lines(), out, checkpoint).awaitTermination()
    assert sorted((r["name"], r["age"]) for r in read_lines(spark, out).collect()) == [("ann", 31), ("bob", 7), ("zoe", 9)]
    assert sorted(r["value"] for r in read_lines(spark, out, rejected=True).collect()) == ["bob#x", "eve#5#6"]


@pytest.mark.parametrize("as_directory", [False, True])
def test_table_stream_reads_a_file_or_a_directory(spark, tmp_path, folder, as_directory):
    source = folder
    if as_directory:
        source = str(tmp_path)
        read_table(spark, folder, "nation").repartition(3).write.parquet(f"{source}/nation.parquet")
    query = (
        stream_table(spark, source, "nation", 1).writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "o"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 25


def test_triggers():
    assert trigger_options(10) == {"processingTime": "10 seconds"}
    assert trigger_options(None) == {"availableNow": True}


class FakeSession:
    def __init__(self, **settings):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, *default: settings.get(key.replace(".", "_"), *default))})()


def test_shared_folder_comes_from_the_session():
    both = {"spark_checkpoint_dir": "hdfs://all/ck/", "spark_sql_warehouse_dir": "hdfs://all/wh"}
    assert shared_folder(FakeSession(**both)) == "hdfs://all/ck"
    assert shared_folder(FakeSession(spark_sql_warehouse_dir="file:/wh")) == "file:/wh/_scratch"


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


# --- declared tables and JSON jobs -------------------------------------------------------------


def test_tables_are_created_from_the_dictionary(spark, dictionary, tmp_path):
    columns = dictionary[0].filter("table_schema = 'ods' AND table_name = 'Users'").withColumn(
        "table_name", F.lit("users_made"))
    jobs = jobs_from_columns(columns, lambda n: None, lambda n: None)
    bad = CopyJob("bad_made", None, None, [Field("x", "nonsense")])
    empty = CopyJob("empty_made", None, None, None)
    for _ in range(2):
        audit = create_tables(spark, [*jobs, bad, empty], folder=str(tmp_path), partition_by=["dt"])
        assert {r["table_name"]: r["status"] for r in audit.collect()} == {
            "users_made": "success", "bad_made": "failed", "empty_made": "skipped"}
    try:
        spark.sql("INSERT INTO users_made (id, dt) VALUES (7, '2024-01-01')")
        row = spark.table("users_made").first()
        assert (row["id"], row["name"], row["dt"]) == (7, "none", "2024-01-01")
        assert spark.table("users_made").schema["name"].metadata["comment"] == "it's\nhers"
    finally:
        spark.sql("DROP TABLE users_made")


def test_copies_from_a_json_file(spark, tmp_path, folder):
    copies = [
        {"name": "orders",
         "source": {"kind": "parquet", "path": f"{folder}/orders.parquet", "columns": ["o_orderkey", "o_orderdate"],
                    "above": ["o_orderdate", "2000-01-01 00:00:00"]},
         "columns": [{"name": "id", "source": "o_orderkey", "type": "bigint", "required": True},
                     {"name": "day", "source": "o_orderdate", "type": "date"}],
         "sink": {"kind": "orc", "path": str(tmp_path / "orders")}},
        {"name": "nation",
         "source": {"kind": "parquet", "path": f"{folder}/nation.parquet"},
         "columns": [{"name": "n_name", "type": "string", "domain": ["CHINA"]}],
         "budget": {"records": 100, "share": None},
         "sink": {"kind": "text", "path": str(tmp_path / "nation"), "delimiter": "#"},
         "rejects": {"kind": "parquet", "path": str(tmp_path / "rejects")}},
        {"name": "odd", "source": {"kind": "parquet", "path": f"{folder}/nation.parquet"}, "sink": {"kind": "odd"}},
    ]
    (tmp_path / "jobs.json").write_text(json.dumps({"channels": 2, "copies": copies}))
    audit = {r["table_name"]: r for r in run_copies(spark, str(tmp_path / "jobs.json")).collect()}
    expected = read_table(spark, folder, "orders").filter("o_orderdate > '2000-01-01'").count()
    assert (audit["orders"]["status"], audit["orders"]["rows_out"]) == ("success", expected)
    assert spark.read.orc(str(tmp_path / "orders")).count() == expected
    assert audit["nation"]["rejected"] == spark.read.parquet(str(tmp_path / "rejects")).count()
    assert audit["odd"]["status"] == "failed" and "odd" in audit["odd"]["error"]


def test_etl_from_a_json_file(spark, tmp_path, folder):
    config = {
        "sources": {"ods_x": {"kind": "parquet", "path": f"{folder}/orders.parquet"}},
        "steps": [{"view": "dws_x", "sql": "SELECT o_orderstatus, count(*) AS n FROM ods_x GROUP BY o_orderstatus"}],
        "sink": {"kind": "parquet_overwrite", "path": str(tmp_path / "out")},
    }
    (tmp_path / "etl.json").write_text(json.dumps(config))
    for _ in range(2):
        run_etl(spark, str(tmp_path / "etl.json"))
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("n")).first()[0] == 1500
    with pytest.raises(ValueError):
        read_source(spark, {"kind": "tape"})


def test_incremental_copies(spark, tmp_path):
    target, marks = str(tmp_path / "rows"), str(tmp_path / "marks")
    fields = [Field("id", "int", required=True), Field("at", "timestamp_ntz", source="changed")]

    def load(rows, name="t", budget=ErrorBudget(1, None)):
        job = CopyJob(name, lambda s: s.createDataFrame(rows, "id string, changed string").withColumn(
            "changed", F.col("changed").cast("timestamp_ntz")), slice_writer(target), fields, budget=budget,
            incremental=Incremental("changed", marks))
        return copy_many(spark, [job]).first()

    assert load([("1", None)], name="empty_marks")["unmarked"] == 1
    first = load([("1", "2024-01-01 00:00:00"), ("x", "2024-01-05 00:00:00.123456"), ("3", None)])
    assert (first["status"], first["rows_in"], first["rows_out"], first["rejected"]) == ("success", 3, 2, 1)
    assert read_mark(spark, marks, "t", "changed") == "2024-01-05 00:00:00.123456"
    over = load([("y", "2024-01-06 00:00:00"), ("z", "2024-01-07 00:00:00")])  # refused: the mark stays
    assert over["status"] == "failed" and read_mark(spark, marks, "t", "changed") == "2024-01-05 00:00:00.123456"
    for _ in range(2):  # nothing new the second time
        again = load([("1", "2024-01-01 00:00:00"), ("6", "2024-01-06 00:00:00"), ("7", None)])
    assert (again["status"], again["rows_in"], again["unmarked"]) == ("success", 0, 1)
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 3, 6]


def test_rows_without_a_mark_are_kept_aside_by_every_load(spark, tmp_path):
    rows, marks, aside = str(tmp_path / "rows"), str(tmp_path / "marks"), str(tmp_path / "aside")

    def load(data):
        df = spark.createDataFrame(data, "id int, changed int")
        result = incremental_load(spark, df, "t", "changed", marks, slice_writer(rows), write_unmarked=unmarked_writer(aside))
        return result.unmarked_rows, sorted(r["id"] for r in spark.read.schema(df.schema).parquet(aside).collect())

    assert load([(1, 10), (2, None)]) == (1, [2])
    assert load([(1, 10), (2, None), (3, None), (4, 20)]) == (2, [2, 3])
    assert load([(1, 10), (2, 30), (3, None), (4, 20)]) == (1, [3])
    assert sorted(r["id"] for r in spark.read.parquet(rows).collect()) == [1, 2, 4]


def test_the_largest_mark_counts_whatever_the_clock_says(spark, tmp_path):
    marks = str(tmp_path / "marks")
    for mark in ("9", "100", "20"):
        store_mark(spark, marks, "t", "changed", mark)
    assert read_mark(spark, marks, "t", "changed", LongType()) == "100"


def test_a_failed_replacement_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    sink.overwrite_parquet(spark.range(5), path)
    with pytest.raises(Exception):
        sink.overwrite_parquet(spark.range(9).select(F.assert_true(F.col("id") < 7).cast("string"), "id"), path)
    assert spark.read.parquet(path).count() == 5
    sink.overwrite_parquet(spark.range(9), path)
    assert spark.read.parquet(path).count() == 9
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_nested_day_folders_expire(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-03-01", 2), ("b", "2024-01-02", 3), ("b", "none", 4)], "region string, day string, n int")
    sink.append_partitioned(df, str(tmp_path / "t"), ["region", "day"])
    gone = sink.delete_expired_folders(spark, str(tmp_path / "t"), "day", dt.date(2024, 3, 10), 30)
    assert gone == ["region=a/day=2024-01-01", "region=b/day=2024-01-02"]
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [2, 4]


def test_broken_keys_are_rejected(spark, tmp_path):
    rows = [(1, "a"), (1, "b"), (None, "c"), (2, "d"), (3, "d"), (4, None), (5, None)]
    specs = (KeySpec("PRIMARY", ("id",), primary=True), KeySpec("uk", ("name",)))
    job = CopyJob(
        "t", lambda s: s.createDataFrame(rows, "id int, name string"), lambda df: sink.overwrite_parquet(df, str(tmp_path / "good")),
        keys=specs, budget=ErrorBudget(None, 1.0), write_rejects=lambda df: sink.overwrite_parquet(df, str(tmp_path / "bad")))
    assert copy_many(spark, [job]).first()["rejected"] == 5
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "good")).collect()) == [4, 5]
    bad = {(r["id"], r["name"]): r[REASONS] for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert bad == {(1, "a"): ["key:PRIMARY"], (1, "b"): ["key:PRIMARY"], (None, "c"): ["key:PRIMARY"], (2, "d"): ["key:uk"], (3, "d"): ["key:uk"]}


def test_lengths_and_domains_come_from_the_type_text():
    rows = [{"column_name": n, "column_type": t} for n, t in
            (("a", "varchar(20)"), ("b", "CHAR(3)"), ("c", "enum('x','it''s')"), ("d", "int(10)"), ("e", "varchar"), ("f", "VARCHAR2(7 BYTE)"))]
    fields = fields_from_metadata(rows)
    assert [f.length for f in fields] == [20, 3, None, None, None, 7]
    assert fields[2].domain == ("x", "it's") and fields[0].domain == ()


def test_overlap_reads_late_rows_again(spark, tmp_path):
    marks, seen = str(tmp_path / "marks"), []

    def load(rows, overlap=None):
        def write(df, start):
            path = str(tmp_path / f"load{len(seen)}")
            df.write.parquet(path)
            seen.append(sorted(r["changed"] for r in spark.read.parquet(path).collect()))

        incremental_load(spark, spark.createDataFrame(rows, "changed int"), "t", "changed", marks, write, overlap)

    load([(10,), (20,)])
    load([(10,), (17,), (20,), (30,)], F.lit(5))
    assert seen == [[10, 20], [17, 20, 30]]
    assert read_mark(spark, marks, "t", "changed") == "30"


def test_incremental_copies_from_a_json_file(spark, tmp_path, folder):
    copy = {
        "name": "orders",
        "source": {"kind": "parquet", "path": f"{folder}/orders.parquet", "columns": ["o_orderkey", "o_orderdate"]},
        "incremental": {"column": "o_orderdate", "marks": str(tmp_path / "marks")},
        "sink": {"kind": "slices", "path": str(tmp_path / "orders")},
    }
    (tmp_path / "jobs.json").write_text(json.dumps({"copies": [copy]}))
    counts = [run_copies(spark, str(tmp_path / "jobs.json")).first()["rows_out"] for _ in range(2)]
    assert counts == [1500, 0]
    assert spark.read.parquet(str(tmp_path / "orders")).count() == 1500


def test_dictionary_marks_incremental_tables(dictionary):
    columns = dictionary[0].filter("table_schema = 'ods'")
    jobs = jobs_from_columns(columns, lambda n: None, lambda n: None, mark_columns={"USERS": "changed"}, marks="m")
    assert {j.name: j.incremental for j in jobs} == {
        "orders": None, "users": Incremental("changed", "m"), "v_users": None}


def test_oracle_dictionary_in_upper_case(spark):
    columns = spark.createDataFrame(
        [("ORDERS", 1, "ID", "NUMBER", Decimal("10.0"), Decimal("0.0"), "N", None),
         ("ORDERS", 2, "TOTAL", "NUMBER", Decimal("12.0"), Decimal("2.0"), "Y", "money"),
         ("ORDERS", 3, "NOTE", "VARCHAR2", None, None, "Y", None)],
        "TABLE_NAME string, ORDINAL_POSITION int, COLUMN_NAME string, COLUMN_TYPE string, DATA_PRECISION decimal(38,10), "
        "DATA_SCALE decimal(38,10), IS_NULLABLE string, COLUMN_COMMENT string",
    )
    def types(mode):
        job, = jobs_from_columns(columns, lambda n: None, lambda n: None, dialect="oracle", mode=mode)
        return [(f.name, f.type, f.required, f.comment) for f in job.fields]

    assert types("lossless") == [
        ("id", "bigint", True, ""), ("total", "decimal(12,2)", False, "money"), ("note", "string", False, "")]
    assert [t[1] for t in types("reference")] == ["int", "double", "string"]


@pytest.mark.parametrize(
    "flow, schema, lines, read, expected",
    [
        ({"kind": "lines", "target": "{0}/out", "checkpoint": "{0}/c"}, None, ["ann#31", "x"],
         lambda s, base: read_lines(s, f"{base}/out").select("name", "age"), [("ann", 31)]),
        ({"kind": "changes", "root": "{0}/state", "keys": ["id"], "order": ["seq"]}, "op string, seq bigint, id int",
         ['{"op":"I","seq":1,"id":1}', '{"op":"I","seq":2,"id":2}', '{"op":"D","seq":3,"id":1}'],
         lambda s, base: current_rows(s, f"{base}/state", ["id"], ["seq"]), [("I", 2, 2)]),
        ({"kind": "inserts", "target": "{0}/out", "checkpoint": "{0}/c"}, "op string, seq bigint, id int",
         ['{"op":"I","seq":1,"id":1}', '{"op":"D","seq":3,"id":1}'],
         lambda s, base: s.read.parquet(f"{base}/out"), [("I", 1, 1)]),
        ({"kind": "alerts", "target": "{0}/out", "checkpoint": "{0}/c", "tables": ["t"]},
         "kind string, db string, tbl string, seq bigint, rows array<struct<values:struct<id:int>,"
         "before_values:struct<id:int>,after_values:struct<id:int>>>",
         ['{"kind":"insert","db":"d","tbl":"t","seq":1,"rows":[{"values":{"id":5}}]}',
          '{"kind":"insert","db":"d","tbl":"u","seq":2,"rows":[{"values":{"id":6}}]}'],
         lambda s, base: s.read.json(f"{base}/out").select("event_type", "data"), [("INSERT", '{"id":5}')]),
    ],
)
def test_streams_from_a_json_file(spark, tmp_path, flow, schema, lines, read, expected):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.txt").write_text("\n".join(lines))
    flow = {key: value.format(tmp_path) if isinstance(value, str) else value for key, value in flow.items()}
    source = {"kind": "files", "path": str(tmp_path / "feed"), **({"schema": schema} if schema else {})}
    (tmp_path / "stream.json").write_text(json.dumps({"source": source, "flow": flow}))
    start_stream(spark, str(tmp_path / "stream.json")).awaitTermination()
    assert [tuple(r) for r in read(spark, str(tmp_path)).collect()] == expected


def test_broken_message_stops_the_stream(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.txt").write_text('{"op":"I","seq":1,"id":1}\nnot json')
    config = {"source": {"kind": "files", "path": str(tmp_path / "feed"), "schema": "op string, seq bigint, id int"},
              "flow": {"kind": "changes", "root": str(tmp_path / "s"), "keys": ["id"], "order": ["seq"]}}
    (tmp_path / "stream.json").write_text(json.dumps(config))
    with pytest.raises(StreamingQueryException):
        start_stream(spark, str(tmp_path / "stream.json")).awaitTermination()
    for part in ("source", "flow"):
        bad = {**config, part: {**config[part], "kind": "odd"}}
        (tmp_path / "bad.json").write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            start_stream(spark, str(tmp_path / "bad.json"))
