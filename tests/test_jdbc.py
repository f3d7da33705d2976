"""JDBC calls, recorded instead of run: no database is started for the tests.

The MERGE text is run by DuckDB, the check tool, in memory.
"""

import random
from unittest.mock import MagicMock

import duckdb
import pytest

from odsflow.functions.ranges import even_edges, range_predicates
from odsflow.sinks import jdbc as sink
from odsflow.sources import jdbc as source

URL = "jdbc:mysql://host/db"


def test_partitioned_read_passes_the_bounds():
    spark = MagicMock()
    source.jdbc_partitioned_read(spark, URL, "orders", "id", 1, 10_000_000, slices=8, properties={"user": "u"})
    spark.read.jdbc.assert_called_once_with(
        URL, "orders", column="id", lowerBound=1, upperBound=10_000_000, numPartitions=8,
        properties={"fetchsize": "1024", "user": "u"},
    )


def test_partitioned_read_asks_for_missing_bounds():
    spark = MagicMock()
    spark.read.format.return_value.options.return_value.load.return_value.first.return_value = (5, 900, 896)
    source.jdbc_partitioned_read(spark, URL, "orders", "id", slices=4)
    assert "MIN(id)" in spark.read.format.return_value.options.call_args.kwargs["query"]
    kwargs = spark.read.jdbc.call_args.kwargs
    assert (kwargs["lowerBound"], kwargs["upperBound"], kwargs["numPartitions"]) == (5, 900, 4)


@pytest.mark.parametrize("bounds", [(None, None, 0), (7, 7, 1)])
def test_empty_or_single_key_tables_are_read_in_one_go(bounds):
    spark = MagicMock()
    spark.read.format.return_value.options.return_value.load.return_value.first.return_value = bounds
    source.jdbc_partitioned_read(spark, URL, "orders", "id")
    spark.read.jdbc.assert_called_once_with(URL, "orders", properties={"fetchsize": "1024"})


def test_slices_follow_the_rows():
    spark = MagicMock()
    spark.read.format.return_value.options.return_value.load.return_value.first.return_value = (1, 10**10, 10**9)
    source.jdbc_partitioned_read(spark, URL, "orders", "id")
    assert spark.read.jdbc.call_args.kwargs["numPartitions"] == 500
    assert [source.slices_for(n) for n in (0, 10, 16_000_001)] == [8, 8, 9]


def test_uneven_keys_are_cut_at_their_quantiles(monkeypatch):
    spark = MagicMock()
    spark.read.format.return_value.options.return_value.load.return_value.first.return_value = (1, 9, 100)
    monkeypatch.setattr(source, "quantiles", lambda keys, column, slices: [5, 5, 9])
    source.jdbc_column_read(spark, URL, "orders", ["id", "user_no"], "user_no", slices=4, salt="id")
    predicates = spark.read.jdbc.call_args.kwargs["predicates"]
    assert sum("MOD(ABS(id), 2)" in p for p in predicates) == 2 and len(predicates) == 5


def test_salted_slices_take_every_row_once(spark):
    """Also negative salts, the least long (whose ABS overflows) and NULL."""
    salts = [*range(-7, 8), -(1 << 63), (1 << 63) - 1, None]
    rows = spark.createDataFrame([(5, n) for n in salts], "user_no long, id long")
    predicates = source.skewed_predicates("user_no", [5, 5, 5, 9], "id")
    assert [sum(rows.filter(p).filter("id <=> %s" % ("NULL" if n is None else f"{n}L" if n > -(1 << 63) else "-9223372036854775807L - 1")).count() for p in predicates)
            for n in (salts[0], 0, 4, salts[-3], salts[-2], None)] == [1] * 6
    assert sum(rows.filter(p).count() for p in predicates) == len(salts)


def test_column_and_sliced_reads():
    spark = MagicMock()
    source.jdbc_column_read(spark, URL, "orders", ["id", "total"])
    spark.read.jdbc.return_value.select.assert_called_once_with("id", "total")
    predicates = range_predicates("id", even_edges(0, 99, 4))
    source.jdbc_sliced_read(spark, URL, "orders", predicates)
    assert spark.read.jdbc.call_args.kwargs["predicates"] == predicates and len(predicates) == 4


def test_append_and_reload_options():
    df = MagicMock()
    sink.jdbc_append(df, URL, "t", {"user": "u"}, connections=3)
    df.repartition.assert_called_once_with(3)  # a shuffle: the work before it keeps its tasks
    df = df.repartition.return_value
    df.write.mode.assert_called_once_with("append")
    df.write.mode.return_value.options.assert_called_once_with(batchsize="5000", numPartitions="3", user="u")
    df = MagicMock()
    sink.jdbc_truncate_load(df, URL, "t")
    df = df.repartition.return_value
    df.write.mode.assert_called_once_with("overwrite")
    options = df.write.mode.return_value.options.call_args.kwargs
    assert (options["truncate"], options["batchsize"]) == ("true", "1024")


def test_statement_closes_its_connection_on_failure():
    spark = MagicMock()
    connection = spark._jvm.java.sql.DriverManager.getConnection.return_value
    connection.createStatement.return_value.execute.side_effect = RuntimeError("refused")
    with pytest.raises(RuntimeError):
        sink.jdbc_execute(spark, URL, "DELETE FROM t", {"driver": "x.Y", "user": "u"})
    connection.close.assert_called_once()


def test_upsert_fills_the_staging_table_first():
    latest = MagicMock()
    latest.columns = ["id", "op", "seq"]
    execute = latest.sparkSession._jvm.java.sql.DriverManager.getConnection.return_value.createStatement.return_value
    writer, names = latest.repartition.return_value.write.mode.return_value.options.return_value, []
    for _ in range(2):
        sink.jdbc_upsert(latest, URL, "t", ["id"], ["seq"])
        own = writer.jdbc.call_args.args[1]
        merge, drop = (call.args[0] for call in execute.execute.call_args_list[-2:])
        assert own.startswith("t_staging_") and merge.startswith("MERGE INTO t t USING (SELECT") and f"FROM {own})" in merge
        assert drop == f"DROP TABLE {own}"
        names.append(own)
    assert names[0] != names[1]
    sink.jdbc_upsert(latest, URL, "t", ["id"], ["seq"], staging="mine")
    assert writer.jdbc.call_args.args[1] == "mine" and "DROP" not in execute.execute.call_args.args[0]


@pytest.mark.parametrize("seed", range(3))
def test_merge_text_keeps_the_latest_row(seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(8), rng.choice("IUD"), rng.randrange(5), n) for n in range(60)]
    rng.shuffle(rows)
    con = duckdb.connect()
    for table in ("t", "s0"):
        con.execute(f"CREATE TABLE {table} (id INT, op TEXT, major INT, minor INT)")
    merge = sink.merge_statement("t", "s0", ["id", "op", "major", "minor"], ["id"], ["major", "minor"])
    for start in range(0, len(rows), 10):
        last = {}
        for row in sorted(rows[start:start + 10], key=lambda r: r[2:]):
            last[row[0]] = row
        con.execute("DELETE FROM s0")
        con.executemany("INSERT INTO s0 VALUES (?, ?, ?, ?)", list(last.values()) * 2)  # a task ran twice
        for _ in range(2):  # a replay changes nothing
            con.execute(merge)
    expected = {}
    for row in sorted(rows, key=lambda r: r[2:]):
        expected[row[0]] = row
    assert sorted(con.execute("SELECT * FROM t").fetchall()) == sorted(expected.values())


# --- streams into a database, with the database calls recorded ---------------------------------


def test_change_stream_upserts_each_batch(spark, tmp_path, monkeypatch):
    from odsflow.streaming import upsert

    calls = []
    monkeypatch.setattr(upsert, "jdbc_upsert", lambda df, url, target, keys, order, properties: calls.append(
        (url, target, sorted(tuple(r) for r in df.collect()))))
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.json").write_text('{"op":"I","seq":1,"id":1}\n{"op":"U","seq":2,"id":1}\n{"op":"D","seq":3,"id":2}')
    changes = spark.readStream.schema("op string, seq bigint, id int").json(str(feed))
    upsert.upsert_stream_jdbc(changes, URL, "t", ["id"], ["seq"], str(tmp_path / "c"), seconds=None).awaitTermination()
    assert calls == [(URL, "t", [("D", 3, 2), ("U", 2, 1)])]


def test_line_stream_clears_its_batch_before_it_appends(spark, tmp_path, monkeypatch):
    from odsflow.streaming import delimited

    calls = []
    monkeypatch.setattr(delimited, "jdbc_execute", lambda s, url, statement, properties: calls.append(statement))
    monkeypatch.setattr(delimited, "jdbc_append", lambda df, url, table, properties: calls.append(
        sorted(tuple(r) for r in df.collect())))
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.txt").write_text("ann#31\nbad\nzoe#9\n")
    delimited.append_lines_jdbc(
        spark.readStream.text(str(feed)), URL, "t", str(tmp_path / "c"), seconds=None).awaitTermination()
    own = delimited.stream_id(spark, str(tmp_path / "c"))
    assert calls == [f"DELETE FROM t WHERE stream_id = '{own}' AND batch_id = 0", [("ann", 31, own, 0), ("zoe", 9, own, 0)]]
    kept = spark.read.parquet(str(tmp_path / "c_rejects")).collect()
    assert [(r["value"], r["stream_id"], r["batch_id"]) for r in kept] == [("bad", own, 0)]
    delimited.append_lines_jdbc(
        spark.readStream.text(str(feed)), URL, "t", str(tmp_path / "d"), seconds=None).awaitTermination()
    assert own not in calls[2] and spark.read.parquet(str(tmp_path / "d_rejects")).count() == 1
