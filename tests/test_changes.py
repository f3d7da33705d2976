import json
import random

import pytest
from pyspark.sql import functions as F

from odsflow.operators.changes import alerts, latest_per_key, latest_state, merge_state, normalise_changes, to_changes
from odsflow.streaming import upsert
from odsflow.streaming.upsert import append_inserts, current_rows, full_state, upsert_stream

ROW = "struct<id:int,name:string>"
FEED = f"kind string, db string, tbl string, seq bigint, rows array<struct<values:{ROW},before_values:{ROW},after_values:{ROW}>>"
CHANGE = "op string, seq bigint, id int, name string"


def values(*row):
    return (row, None, None)


def pair(before, after):
    return (None, before, after)


@pytest.fixture
def feed(spark):
    return spark.createDataFrame(
        [
            ("insert", "shop", "t", 1, [values(1, "a"), values(2, "b")]),
            ("update", "shop", "t", 2, [pair((1, "a"), (1, "aa"))]),
            ("update", "shop", "t", 3, [pair((2, "b"), (3, "b"))]),
            ("delete", "shop", "t", 4, [values(1, "aa")]),
            ("insert", "other", "t", 5, [values(9, "z")]),
            ("insert", "shop", "u", 6, [values(9, "z")]),
            ("rotate", "shop", "t", 7, [values(9, "z")]),
            ("insert", "shop", "t", 8, []),
        ],
        FEED,
    )


def test_normalise_keeps_named_tables_and_kinds(feed):
    rows = normalise_changes(feed, ["shop"], ["t"]).orderBy("seq", "row_no").collect()
    assert [(r["op"], r["seq"], r["row_no"]) for r in rows] == [
        ("I", 1, 0), ("I", 1, 1), ("U", 2, 0), ("U", 3, 0), ("D", 4, 0), ("I", 8, None),  # the last has no rows
    ]
    assert rows[0]["old"] is None and rows[0]["new"]["name"] == "a"
    assert rows[2]["old"]["name"] == "a" and rows[2]["new"]["name"] == "aa"
    assert rows[4]["old"]["name"] == "aa" and rows[4]["new"] is None
    assert normalise_changes(feed, ["shop"], ["t"], ["delete"]).count() == 1
    assert normalise_changes(feed).count() == 8


def test_alerts_are_readable(feed):
    rows = alerts(normalise_changes(feed, ["shop"], ["t"])).orderBy("seq", "row_no").collect()
    assert [r["event_type"] for r in rows] == ["INSERT", "INSERT", "UPDATE", "UPDATE", "DELETE", "INSERT"]
    assert json.loads(rows[2]["data"]) == {"old": {"id": 1, "name": "a"}, "new": {"id": 1, "name": "aa"}}
    assert json.loads(rows[4]["data"]) == {"id": 1, "name": "aa"}


def test_a_moved_key_is_deleted_and_set(feed):
    changes = to_changes(normalise_changes(feed, ["shop"], ["t"]), ["id"])
    moved = {(r["op"], r["id"]) for r in changes.filter("seq = 3").collect()}
    assert moved == {("D", 2), ("U", 3)}
    live = {(r["id"], r["name"]) for r in latest_state(changes, ["id"], ["seq", "row_no"]).collect()}
    assert live == {(3, "b")}


def test_late_update_does_not_revive(spark):
    log = spark.createDataFrame([("I", 1, 1, "a"), ("D", 3, 1, "a"), ("U", 2, 1, "late")], CHANGE)
    assert latest_state(log, ["id"], ["seq"]).count() == 0
    assert latest_per_key(log, ["id"], ["seq"]).first()["op"] == "D"


def random_log(seed, size=300, keys=25):
    rng = random.Random(seed)
    key = lambda: 0 if rng.random() < 0.34 else rng.randrange(1, keys)  # one key holds a third
    rows = [(rng.choice("IUUUD"), seq, key(), f"v{seq}") for seq in range(size)]
    rows.append(("U", size, None, "no key"))
    rng.shuffle(rows)
    return rows


def expected_state(rows):
    last = {}
    for op, seq, key, name in sorted(rows, key=lambda r: r[1]):
        last[key] = (op, seq, name)
    return {(key, seq, name) for key, (op, seq, name) in last.items() if op != "D"}


def found_state(df):
    return {(r["id"], r["seq"], r["name"]) for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_merging_parts_equals_one_pass(spark, seed):
    rows = random_log(seed)
    log = spark.createDataFrame(rows, CHANGE)
    assert found_state(latest_state(log, ["id"], ["seq"])) == expected_state(rows)
    cut = random.Random(seed).randrange(1, len(rows))
    first = latest_per_key(spark.createDataFrame(rows[:cut], CHANGE), ["id"], ["seq"])
    second = latest_per_key(spark.createDataFrame(rows[cut:], CHANGE), ["id"], ["seq"])
    merged = merge_state(first, second, ["id"], ["seq"])
    assert merged.count() == len({r[2] for r in rows})
    assert found_state(merged.filter("op <> 'D'")) == expected_state(rows)
    replayed = merge_state(merged, second, ["id"], ["seq"])
    assert found_state(replayed.filter("op <> 'D'")) == expected_state(rows)


def test_merge_does_not_shuffle_the_base(spark, tmp_path):
    path = str(tmp_path / "base")
    spark.range(1000).selectExpr("'I' op", "id seq", "CAST(id AS INT) id", "'n' name").write.parquet(path)
    changes = str(tmp_path / "changes")
    spark.createDataFrame([("U", 5000, 3, "x"), ("I", 5001, 2000, "y")], CHANGE).write.parquet(changes)
    plan = merge_state(spark.read.parquet(path), spark.read.parquet(changes), ["id"], ["seq"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text and text.count("BroadcastHashJoin") >= 3


# --- streams -----------------------------------------------------------------------------------

def write_files(spark, rows, folder, parts, seed):
    """The log as JSON files, split at random, one file per micro-batch."""
    rng = random.Random(seed)
    groups = [[] for _ in range(parts)]
    for row in rows:
        rng.choice(groups).append(row)
    folder.mkdir(exist_ok=True)
    for number, group in enumerate(groups):
        lines = [json.dumps(dict(zip(("op", "seq", "id", "name"), row))) for row in group]
        (folder / f"part-{seed}-{number}.json").write_text("\n".join(lines))


def json_stream(spark, folder):
    return spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 1).json(str(folder))


@pytest.mark.parametrize("compact_every", [2, 100])
def test_stream_equals_batch_also_after_restart(spark, tmp_path, compact_every):
    rows, feed, root = random_log(7), tmp_path / "feed", str(tmp_path / "state")
    first, second = rows[:180], rows[180:]
    write_files(spark, first, feed, 4, seed=1)
    for part in (first, rows):
        upsert_stream(json_stream(spark, feed), root, ["id"], ["seq"], compact_every=compact_every).awaitTermination()
        assert found_state(current_rows(spark, root, ["id"], ["seq"])) == expected_state(part)
        if part is first:
            write_files(spark, second, feed, 3, seed=2)


def batches(spark, rows, size=60):
    return [spark.createDataFrame(rows[i:i + size], CHANGE) for i in range(0, len(rows), size)]


def test_replayed_and_half_written_batches(spark, tmp_path):
    rows, root, keys, order = random_log(11), str(tmp_path / "state"), ["id"], ["seq"]
    parts = batches(spark, rows)
    for number, part in enumerate(parts):
        upsert.write_batch(part, number, root, keys, order)
        upsert.write_batch(part, number, root, keys, order)  # replay after a crash before the checkpoint
    # a crash in the middle of a write leaves a folder without its mark: readers pass over it
    half = tmp_path / "state" / "changes" / f"batch_id={len(parts)}"
    half.mkdir()
    (half / "part-0.parquet").write_text("half a file")
    assert found_state(current_rows(spark, root, keys, order)) == expected_state(rows)
    more = [("U", 10_000, 1, "late"), ("D", 10_001, 0, "gone")]
    upsert.write_batch(spark.createDataFrame(more, CHANGE), len(parts), root, keys, order)
    assert found_state(current_rows(spark, root, keys, order)) == expected_state(rows + more)


def test_compaction_and_clean_up_keep_the_state(spark, tmp_path):
    rows, root, keys, order = random_log(13), str(tmp_path / "state"), ["id"], ["seq"]
    upsert.load_snapshot(spark.createDataFrame([("I", -1, 500, "old"), ("I", -1, 1, "old")], CHANGE), root)
    snapshot = [("I", -1, 500, "old"), ("I", -1, 1, "old")]
    for number, part in enumerate(batches(spark, rows)):
        upsert.write_batch(part, number, root, keys, order)
        if number % 2:
            assert upsert.compact(spark, root, keys, order) == number
            assert upsert.compact(spark, root, keys, order) is None
    assert found_state(current_rows(spark, root, keys, order)) == expected_state(snapshot + rows)
    assert upsert.drop_superseded(spark, root, keep=2) > 0
    assert upsert.drop_superseded(spark, root, keep=2) == 0
    assert found_state(current_rows(spark, root, keys, order)) == expected_state(snapshot + rows)
    # an interrupted compaction has no mark and is ignored
    (tmp_path / "state" / "base" / "upto=99").mkdir()
    assert found_state(current_rows(spark, root, keys, order)) == expected_state(snapshot + rows)


def test_lost_checkpoint_is_refused(spark, tmp_path):
    root = str(tmp_path / "state")
    upsert.write_batch(spark.createDataFrame([("I", 1, 1, "a")], CHANGE), 0, root, ["id"], ["seq"])
    (tmp_path / "feed").mkdir()
    with pytest.raises(ValueError, match="checkpoint"):
        upsert_stream(json_stream(spark, tmp_path / "feed"), root, ["id"], ["seq"])
    with pytest.raises(ValueError, match="no state"):
        full_state(spark, str(tmp_path / "nothing"), ["id"], ["seq"])


def test_append_mode_takes_inserts_once(spark, tmp_path):
    rows, feed = random_log(3), tmp_path / "feed"
    write_files(spark, rows, feed, 3, seed=5)
    for _ in range(2):
        append_inserts(
            json_stream(spark, feed), str(tmp_path / "out"), str(tmp_path / "checkpoint")
        ).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["seq"] for r in stored.collect()) == sorted(r[1] for r in rows if r[0] == "I")
