"""Loads that go on: keys across loads, chunked copies, summaries from changes, digests, feed positions, dictionaries."""

import json
import random
import time
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odsflow import session as session_module
from odsflow.functions.ranges import literal, range_predicates, skewed_predicates, slices_of, sorted_cuts, tuple_predicates
from odsflow.operators import digests, key_index, positions
from odsflow.operators.quality import REASONS, BudgetExceeded, ErrorBudget, KeySpec
from odsflow.plans import load_queries
from odsflow.plans.config import run_copies, start_stream
from odsflow.plans.dictionary import copy_plan, jobs_from_plan
from odsflow.plans.jobs import CopyJob, Incremental, copy_table, jobs_from_columns
from odsflow.sinks import clustered, tables as sink
from odsflow.sources.incremental import slice_writer
from odsflow.streaming import budget, chunks, flush, summaries, upsert

QUICK = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# --- keys across loads ---------------------------------------------------------------------------

SPEC = KeySpec("uk", ("a", "b"))


def pairs(spark, rows):
    return spark.createDataFrame(rows, "a long, b string").withColumn(REASONS, F.array().cast("array<string>"))


def flagged(df):
    return sorted((r["a"], r["b"]) for r in df.collect() if r[REASONS])


def test_known_keys_are_found_exactly(spark, tmp_path):
    index = key_index.open_index(spark, str(tmp_path), SPEC, 1000)
    assert flagged(key_index.with_known_keys(pairs(spark, [(1, "x")]), [index])) == []
    key_index.add_keys(index, pairs(spark, [(i, f"k{i}") for i in range(500)] + [(None, "n"), (7, None)]), "one")
    key_index.add_keys(index, pairs(spark, [(i, "two") for i in range(3)]), "load/2 é")
    asked = [(1, "k1"), (1, "k2"), (499, "k499"), (500, "k500"), (2, "two"), (None, "n"), (7, None), (1, "k1")]
    assert flagged(key_index.with_known_keys(pairs(spark, asked), [index])) == [(1, "k1"), (1, "k1"), (2, "two"), (499, "k499")]
    # a load that is repeated does not find itself, and replaces what it stored
    assert flagged(key_index.with_known_keys(pairs(spark, asked), [index], "one")) == [(2, "two")]
    key_index.add_keys(index, pairs(spark, [(9, "nine")]), "one")
    assert flagged(key_index.with_known_keys(pairs(spark, [*asked, (9, "nine")]), [index])) == [(2, "two"), (9, "nine")]
    report = key_index.index_report(spark, index).first()
    assert (report["loads"], report["keys"]) == (2, 4) and 0 < report["filled"] < 0.01


def test_the_filter_rules_out_nearly_all_new_keys(spark, tmp_path):
    index = key_index.open_index(spark, str(tmp_path), SPEC, 20_000)
    rows = spark.range(20_000).select(F.col("id").alias("a"), F.lit("x").alias("b"))
    key_index.add_keys(index, rows, "one")
    known = key_index.candidates(index, rows)
    assert known.count() == 20_000  # never misses one
    new = key_index.candidates(index, rows.select((F.col("a") + 1_000_000).alias("a"), "b")).count()
    assert new < 20_000 * 0.03
    assert 0.3 < key_index.index_report(spark, index).first()["filled"] < 0.6


def test_only_buckets_of_candidates_are_read(spark, tmp_path):
    index = key_index.open_index(spark, str(tmp_path), SPEC, 100)
    key_index.add_keys(index, pairs(spark, [(i, "x") for i in range(2000)]), "one")
    plan = key_index.known_keys(index, pairs(spark, [(5, "x"), (6, "y")]))._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters: [", 1)[1].split("]", 1)[0] for line in plan.splitlines() if "FileScan" in line]
    assert sorted(bool(f) for f in filters) == [False, True] and any("_bucket" in f for f in filters)


def test_without_candidates_nothing_is_joined(spark, tmp_path):
    index = key_index.open_index(spark, str(tmp_path), SPEC, 100_000)
    key_index.add_keys(index, pairs(spark, [(1, "x")]), "one")
    rows = pairs(spark, [(2, "x"), (3, "x")])
    assert "Join" not in key_index.with_known_keys(rows, [index])._jdf.queryExecution().executedPlan().toString()


def test_an_index_is_of_one_key_and_can_be_rebuilt(spark, tmp_path):
    index = key_index.open_index(spark, str(tmp_path / "i"), SPEC, 10)
    for load in range(3):
        key_index.add_keys(index, pairs(spark, [(load, "x"), (load, "y")]), str(load))
    with pytest.raises(ValueError, match="not of b"):
        key_index.open_index(spark, str(tmp_path / "i"), KeySpec("other", ("b",)))
    fresh = key_index.rebuild(spark, index, str(tmp_path / "larger"), 1_000_000)
    assert fresh.blocks > index.blocks and key_index.index_report(spark, fresh).first()["keys"] == 6
    assert flagged(key_index.with_known_keys(pairs(spark, [(2, "y"), (3, "y")]), [fresh])) == [(2, "y")]


def test_copies_check_keys_of_earlier_loads(spark, tmp_path):
    """A load that is run again from the same mark does not reject its own rows."""
    def job(rows, **more):
        return CopyJob("t", lambda s: s.createDataFrame(rows, "id int, t int"), slice_writer(f"{tmp_path}/rows"),
                       keys=(KeySpec("PRIMARY", ("id",), True),), budget=ErrorBudget(None, 1.0), **more)

    mark = Incremental("t", f"{tmp_path}/marks")
    options = {"incremental": mark, "key_index": f"{tmp_path}/index"}
    assert copy_table(spark, job([(1, 1), (2, 2)], **options)).rejected == 0
    late = [(1, 1), (2, 2), (2, 3), (4, 3), (5, 4), (5, 4)]
    assert copy_table(spark, job(late, **options)).rejected == 3
    import shutil
    shutil.rmtree(f"{tmp_path}/marks")  # as if the crash came before the mark: the first load again
    assert copy_table(spark, job([(1, 1), (2, 2)], **options)).rejected == 0
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/rows").collect()) == [1, 2, 4]
    with pytest.raises(ValueError, match="only an incremental"):
        copy_table(spark, job([(1, 1)], key_index=f"{tmp_path}/index"))


# --- chunked copies ------------------------------------------------------------------------------

def random_log(rng, n_keys, n):
    """A table at first and events (seq, op, key, value) that fit it."""
    table = {k: f"v{k}" for k in range(n_keys) if rng.random() < 0.6}
    state, log = dict(table), []
    for seq in range(1, n + 1):
        k = rng.randrange(n_keys)
        if k in state and rng.random() < 0.4:
            del state[k]
            log.append((seq, "D", k, "gone"))
        else:
            log.append((seq, "U" if k in state else "I", k, f"e{seq}"))
            state[k] = f"e{seq}"
    return table, log, state


def as_of(table, log, position):
    state = dict(table)
    for seq, op, k, v in log:
        if seq <= position:
            state.pop(k, None)
            if op != "D":
                state[k] = v
    return state


@pytest.mark.parametrize("seed", range(5))
def test_chunks_and_log_in_any_order_give_the_table(spark, tmp_path, seed):
    rng = random.Random(seed)
    table, log, final = random_log(rng, 12, 40)
    root, size = str(tmp_path), rng.choice([1, 3, 5, 12])
    predicates = range_predicates("k", list(range(size, 12, size)))
    clock = [rng.randrange(3)]

    def position():
        return clock[0]

    def read(predicate):
        clock[0] = min(len(log), clock[0] + rng.randrange(6))
        rows = as_of(table, log, clock[0])
        clock[0] = min(len(log), clock[0] + rng.randrange(4))
        return spark.createDataFrame(list(rows.items()), "k int, v string").filter(predicate)

    batches, at = [], 0
    while at < len(log):
        end = at + rng.randrange(1, 25)
        batches.append(log[at:end])
        at = end
    steps = [("chunk", n) for n in range(len(predicates))] + [("batch", n) for n in range(len(batches))]
    rng.shuffle(steps)
    for kind, n in steps:
        if kind == "chunk":
            assert chunks.copy_chunks(spark, predicates, read, position, root, [n], channels=1) == [n]
        else:
            rows = spark.createDataFrame([(s, op, k, v) for s, op, k, v in batches[n]], "seq long, op string, k int, v string")
            upsert.write_batch(chunks.log_changes(rows), n, root, ["k"], chunks.ORDER)
        if rng.random() < 0.1:
            upsert.compact(spark, root, ["k"], chunks.ORDER) if [s for s in steps if s[0] == "batch"] == sorted(s for s in steps if s[0] == "batch") else None
    assert chunks.copy_chunks(spark, predicates, read, position, root) == []  # all are there
    assert {r["k"]: r["v"] for r in chunks.current_rows(spark, root, ["k"]).collect()} == final
    assert chunks.unsettled_chunks(spark, root, len(log)) == []
    report = chunks.replaced_rows(spark, root, ["k"]).collect()
    assert len(report) == len(predicates) and all(r["replaced"] <= r["rows"] for r in report)


def test_a_chunk_ahead_of_the_log_is_named(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (9, "b")], "k int, v string")
    clock = iter([3, 8, 8, 9])
    chunks.copy_chunks(spark, ["k < 5", "k >= 5"], lambda p: rows.filter(p), lambda: next(clock), str(tmp_path), channels=1)
    assert chunks.unsettled_chunks(spark, str(tmp_path), 8) == [1]
    assert chunks.unsettled_chunks(spark, str(tmp_path), 7) == [0, 1]
    with pytest.raises(ValueError, match="other predicates"):
        chunks.copy_chunks(spark, ["k < 6", "k >= 6"], lambda p: rows.filter(p), lambda: 9, str(tmp_path))


def test_a_broken_chunk_is_read_again(spark, tmp_path):
    rows, tries = spark.createDataFrame([(1, "a"), (9, "b")], "k int, v string"), []

    def read(predicate):
        tries.append(predicate)
        return rows.filter(predicate).withColumn("v", F.assert_true(F.lit(len(tries) > 1)).cast("string"))

    with pytest.raises(Exception):
        chunks.copy_chunks(spark, ["1 = 1"], read, lambda: 5, str(tmp_path))
    assert chunks.finished_chunks(spark, str(tmp_path)) == []
    chunks.copy_chunks(spark, ["1 = 1"], read, lambda: 5, str(tmp_path))
    assert chunks.current_rows(spark, str(tmp_path), ["k"]).count() == 2


# --- summaries from changes ----------------------------------------------------------------------

SALES = summaries.Summary(group={"day": "CAST(time AS DATE)", "shop": "shop"}, sums={"amount": "amount"}, unit="date_format(time, 'yyyy-MM')", where="amount > 0")
IMAGE = "struct<id: int, shop: string, amount: decimal(10,2), time: timestamp_ntz>"
FEED = f"seq long, kind string, db string, tbl string, rows array<struct<values: {IMAGE}, before_values: {IMAGE}, after_values: {IMAGE}>>"


def random_feed(rng, n):
    """Events of a table of sales, and the table after each."""
    state, events, states = {}, [], []

    def image():
        day = datetime(2024, 1, 1) + timedelta(days=rng.randrange(70), hours=rng.randrange(24))
        return (rng.randrange(15), rng.choice(["a", None, "b"]), rng.choice([None, Decimal("0.00"), Decimal("1.10"), Decimal("2.25")]), day)

    for seq in range(n):
        known = sorted(state)
        kind = rng.choice(["insert", "update", "delete"]) if known else "insert"
        if kind == "insert":
            row = (seq, *image()[1:])
            state[seq], change = row, (row, None, None)
        else:
            k = rng.choice(known)
            if kind == "delete":
                change = (state.pop(k), None, None)
            else:
                row = (k, *image()[1:])
                change = (None, state[k], row)
                state[k] = row
        events.append((seq, kind, "d", "sales", [change]))
        states.append(dict(state))
    return events, states


def recount(rows):
    found = {}
    for _, shop, amount, time in rows:
        if amount and amount > 0:
            n, total = found.get((time.date(), shop), (0, Decimal(0)))
            found[time.date(), shop] = (n + 1, total + amount)
    return found


def test_the_summary_equals_a_recount_after_every_batch(spark, tmp_path):
    rng, root = random.Random(8), str(tmp_path)
    events, states = random_feed(rng, 90)
    cuts = [0, 30, 31, 60, 90]
    schema = None
    for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
        again = rng.sample(events[:b], min(b, 12))  # what came before comes once more
        batch = spark.createDataFrame(events[a:b] + again, FEED)
        touched = summaries.apply_feed(batch, number, root, SALES)
        if number == 2:  # tried again after a crash that lost the answer
            assert summaries.apply_feed(batch, number, root, SALES) == touched
        schema = schema or summaries.deltas(summaries.normalise_changes(batch), SALES).schema
        got = {(r["day"], r["shop"]): (r["row_cnt"], r["amount"]) for r in summaries.current_summary(spark, root, schema).collect()}
        assert got == recount(states[b - 1].values())
    before = summaries.current_summary(spark, root, schema).collect()
    assert summaries.drop_superseded(spark, root, keep=1) > 0
    assert Counter(summaries.current_summary(spark, root, schema).collect()) == Counter(before)


def test_only_touched_units_are_rewritten(spark, tmp_path):
    def sale(seq, day):
        return (seq, "insert", "d", "sales", [((seq, "a", Decimal("1.00"), datetime.fromisoformat(day)), None, None)])

    root = str(tmp_path)
    summaries.apply_feed(spark.createDataFrame([sale(1, "2024-01-05"), sale(2, "2024-02-05")], FEED), 0, root, SALES)
    assert summaries.apply_feed(spark.createDataFrame([sale(3, "2024-02-06")], FEED), 1, root, SALES) == ["unit=2024-02"]
    assert summaries.newest_units(spark, root) == {"unit=2024-01": 0, "unit=2024-02": 1}


def test_an_unfinished_batch_does_not_count(spark, tmp_path):
    root = str(tmp_path)
    event = (1, "insert", "d", "sales", [((1, "a", Decimal("1.00"), datetime(2024, 1, 5)), None, None)])
    batch = spark.createDataFrame([event], FEED)
    summaries.apply_feed(batch, 0, root, SALES)
    (tmp_path / "rows" / "batch_id=0" / "_SUCCESS").unlink()
    schema = summaries.deltas(summaries.normalise_changes(batch), SALES).schema
    assert summaries.current_summary(spark, root, schema).count() == 0
    summaries.apply_feed(batch, 0, root, SALES)
    assert summaries.current_summary(spark, root, schema).first()["row_cnt"] == 1


# --- digests -------------------------------------------------------------------------------------

def versions(spark, old, new):
    schema = "k long, n int, v string"
    return [spark.createDataFrame(rows, schema).repartition(2) for rows in (old, new)]


def compare(spark, tmp_path, old, new, width=4):
    ranges = digests.Ranges("k", width, ("k", "n"))
    frames = versions(spark, old, new)
    tops = tuple(digests.write_tree(df, ranges, f"{tmp_path}/{i}") for i, df in enumerate(frames))
    found = digests.compare_versions(*frames, ranges, f"{tmp_path}/0", f"{tmp_path}/1", tops)
    return {(r["k"], r["n"]): (r["kind"], r["n_old"], r["n_new"]) for r in found.collect()}


def brute_differences(old, new):
    found = {}
    for key in {r[:2] for r in old + new}:
        a, b = (Counter(r for r in rows if r[:2] == key) for rows in (old, new))
        if a != b:
            kind = "insert" if not a else "delete" if not b else "change"
            found[key] = (kind, sum(a.values()), sum(b.values()))
    return found


@pytest.mark.parametrize("seed", range(3))
def test_digest_differences_equal_a_full_comparison(spark, tmp_path, seed):
    rng = random.Random(seed)
    old = [(rng.randrange(-3000, 3000), rng.randrange(3), rng.choice(["x", None, ""])) for _ in range(400)] + [(None, 1, "x"), (5, None, "x"), (5, None, "x")]
    new = [r for r in old if rng.random() > 0.05] + [(rng.randrange(9000), 7, "new") for _ in range(6)]
    new += [(k, n, "other") for k, n, _ in rng.sample(old, 5)] + [old[0], old[0]]
    assert compare(spark, tmp_path, old, new) == brute_differences(old, new)


def test_keys_beyond_doubles(spark, tmp_path):
    big = 2**62
    old = [(big + i, 0, "x") for i in range(-9, 9)] + [(-big - 1, 0, "x"), (-1, 0, "x"), (-4, 0, "x")]
    new = [(k, n, "y" if k in (big + 1, big + 4, -4) else v) for k, n, v in old]
    assert compare(spark, tmp_path, old, new) == brute_differences(old, new)


def test_equal_versions_are_not_read(spark, tmp_path):
    rows = [(i, 0, "x") for i in range(500)]
    assert compare(spark, tmp_path, rows, rows[::-1]) == {}


def test_empty_versions(spark, tmp_path):
    assert compare(spark, tmp_path / "a", [], []) == {}
    assert compare(spark, tmp_path / "b", [], [(1, 1, "x")]) == {(1, 1): ("insert", 0, 1)}


def test_values_that_swap_columns_or_cancel_out_are_seen(spark, tmp_path):
    assert compare(spark, tmp_path / "a", [(1, 1, None)], [(1, None, "1")]).keys() == {(1, 1), (1, None)}
    assert compare(spark, tmp_path / "b", [(1, 1, "x")] * 2, [(1, 1, "y")] * 2) == {(1, 1): ("change", 2, 2)}
    assert compare(spark, tmp_path / "c", [(1, 1, "x")] * 2, [(1, 1, "x")] * 4) == {(1, 1): ("change", 2, 4)}


def test_rows_read_follow_the_changes(spark, tmp_path):
    ranges = digests.Ranges("k", 64, ("k",))
    old = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    new = old.withColumn("v", F.when(F.col("k").isin(7, 50_000), 0).otherwise(F.col("v")))
    for name, df in (("old", old), ("new", new)):
        df.repartitionByRange(8, "k").sortWithinPartitions("k").write.parquet(f"{tmp_path}/{name}")
    frames = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("old", "new")]
    tops = tuple(digests.write_tree(df, ranges, f"{tmp_path}/tree{i}") for i, df in enumerate(frames))
    assert tops[0] >= 2
    cells = digests.differing_cells(spark, f"{tmp_path}/tree0", f"{tmp_path}/tree1", tops, ranges)
    read = digests.rows_in(frames[0], cells, ranges)
    assert read.count() == 2 * 64
    assert "GreaterThanOrEqual(k,49984)" in read._jdf.queryExecution().executedPlan().toString().replace(" ", "")
    found = digests.compare_versions(*frames, ranges, f"{tmp_path}/tree0", f"{tmp_path}/tree1", tops)
    assert sorted(r["k"] for r in found.collect()) == [7, 50_000]


def test_many_changed_ranges_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(digests, "MOST_RANGES", 3)
    old = [(i * 40, 0, "x") for i in range(60)]
    new = [(k, n, "y" if k % 80 == 0 else v) for k, n, v in old]
    assert compare(spark, tmp_path, old, new) == brute_differences(old, new)


# --- positions of a feed -------------------------------------------------------------------------

def brute_runs(numbers):
    counts = Counter(numbers)
    found = []
    for at in range(min(counts), max(counts) + 1):
        if found and found[-1][2] == counts[at]:
            found[-1][1] = at
        else:
            found.append([at, at, counts[at]])
    return [tuple(r) for r in found]


@QUICK
@given(st.lists(st.integers(-40, 40), min_size=1, max_size=60), st.integers(1, 30))
def test_runs_equal_a_plain_count(spark, numbers, block):
    df = spark.createDataFrame([(n,) for n in numbers], "seq long")
    got = positions.runs(positions.boundaries(df, "seq"), block).orderBy("first_seq").collect()
    assert [(r["first_seq"], r["last_seq"], r["times"]) for r in got] == brute_runs(numbers)


def test_batches_add_up_and_fold(spark, tmp_path):
    rng, root = random.Random(2), str(tmp_path)
    numbers = [n for n in range(200) if n % 17] + [30, 30, 31, 150]
    rng.shuffle(numbers)
    for batch in range(5):
        own = numbers[batch::5]
        positions.mark_seen(spark.createDataFrame([(n,) for n in own] + [(None,)], "seq long"), "seq", root, batch)
        if batch == 3:
            assert positions.fold_seen(spark, root) == 3 and positions.fold_seen(spark, root) is None
    got = positions.runs(positions.seen(spark, root)).orderBy("first_seq").collect()
    assert [(r["first_seq"], r["last_seq"], r["times"]) for r in got] == brute_runs(numbers)
    report = positions.gaps_and_repeats(positions.runs(positions.seen(spark, root)))
    assert {r["kind"] for r in report.collect()} == {"gap", "repeat"}


def test_fresh_events(spark, tmp_path):
    held = spark.createDataFrame([(n, "f") for n in [*range(0, 50), *range(60, 90)]], "seq long, feed string")
    steps = positions.boundaries(held, "seq", F.col("feed"))
    rows = [(n, f) for n in (0, 49, 50, 59, 60, 89, 90, 5000, None) for f in ("f", "g")]
    asked = spark.createDataFrame(rows, "seq long, feed string")
    for block in (7, 1 << 20):
        got = positions.fresh(asked, "seq", steps, F.col("feed"), block).collect()
        assert Counter(tuple(r) for r in got) == Counter((n, f) for n, f in rows if f == "g" or n in (50, 59, 90, 5000, None))
    none = spark.createDataFrame([], positions.BOUNDARIES)
    assert positions.fresh(asked, "seq", none, F.col("feed")).count() == len(rows)


def test_fresh_events_of_a_feed_with_a_run_for_every_position(spark):
    """100,000 runs of one position each in one block meet 150,000 events, 200 of them at one position: no event may be compared with every run."""
    n = 200_000
    steps = positions.boundaries(spark.range(0, n, 2).toDF("seq"), "seq")
    asked = spark.range(0, n * 3 // 4).toDF("seq").unionByName(spark.range(100).select(F.lit(4).cast("long").alias("seq")))
    asked = asked.unionByName(spark.range(100).select(F.lit(5).cast("long").alias("seq")))
    started = time.monotonic()
    got = positions.fresh(asked, "seq", steps)
    assert got.agg(F.count("*"), F.min(F.col("seq") % 2)).first() == (n * 3 // 8 + 100, 1)
    assert time.monotonic() - started < 60
    assert "NestedLoop" not in positions.fresh(asked, "seq", steps)._jdf.queryExecution().toString()


def test_a_clean_feed_is_two_rows(spark):
    assert positions.boundaries(spark.range(5, 100_000).toDF("seq"), "seq").count() == 2


# --- dictionaries --------------------------------------------------------------------------------

@pytest.fixture
def listings(spark):
    tables = spark.createDataFrame(
        [("shop", "Users", "BASE TABLE", "x\ny"), ("old", "users", "VIEW", None), ("shop", "empty", "BASE TABLE", None)],
        "TABLE_SCHEMA string, TABLE_NAME string, TABLE_TYPE string, TABLE_COMMENT string")
    columns = spark.createDataFrame(
        [("shop", "Users", 2, "Name", "varchar(20)", "YES"), ("shop", "Users", 1, "ID", "bigint", "NO"), ("old", "users", 1, "uid", "int", "NO")],
        "table_schema string, table_name string, ordinal_position int, column_name string, column_type string, is_nullable string")
    indexes = spark.createDataFrame(
        [("shop", "Users", "uk", 0, 2, "ID"), ("shop", "Users", "uk", 0, 1, "Name"), ("shop", "Users", "PRIMARY", 0, 1, "ID"),
         ("shop", "Users", "plain", 1, 1, "Name"), ("old", "users", "PRIMARY", 0, 1, "uid")],
        "table_schema string, table_name string, index_name string, non_unique int, seq_in_index int, column_name string")
    return tables, columns, indexes


def test_views_and_other_schemas_drop_out(spark, listings):
    row, = copy_plan(*listings).collect()
    assert (row["table_schema"], row["table_name"], row["comment"]) == ("shop", "users", "x y")
    assert [(c["column_name"], c["column_type"], c["nullable"]) for c in row["columns"]] == [("id", "bigint", 0), ("name", "varchar(20)", 1)]
    assert [(k["name"], k["columns"]) for k in row["keys"]] == [("PRIMARY", ["id"]), ("uk", ["name", "id"])]
    assert copy_plan(*listings, schema="old").collect() == []
    assert copy_plan(*listings, schema="OLD", kind="view").first()["table_name"] == "users"
    assert copy_plan(*listings, exclude=["USERS"]).collect() == []
    assert copy_plan(*listings[:2]).first()["keys"] == []


def test_plan_to_jobs_with_keys(spark, listings, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (5, "x" * 30)], "ID int, Name string")
    job, = jobs_from_plan(
        copy_plan(*listings), lambda schema, table: lambda s: rows, lambda schema, table: lambda df: sink.overwrite_parquet(df, f"{tmp_path}/{schema}.{table}"),
        budget=ErrorBudget(None, 1.0))
    assert job.name == "users" and job.keys == (KeySpec("PRIMARY", ("id",), True), KeySpec("uk", ("name", "id")))
    audit = copy_table(spark, job)
    assert (audit.rows_out, audit.rejected) == (1, 4)
    assert spark.read.parquet(f"{tmp_path}/shop.users").collect()[0].asDict() == {"id": 1, "name": "a"}


def test_column_listings_keep_schemas_apart(spark, listings):
    tables, columns, indexes = listings
    with pytest.raises(ValueError, match="users"):
        jobs_from_columns(columns, lambda n: None, lambda n: None)
    job, = jobs_from_columns(columns, lambda n: None, lambda n: None, tables=tables, indexes=indexes)
    assert [f.name for f in job.fields] == ["id", "name"] and [k.name for k in job.keys] == ["PRIMARY", "uk"]
    job, = jobs_from_columns(columns, lambda n: None, lambda n: None, schema="old")
    assert [f.name for f in job.fields] == ["uid"]


# --- key ranges of any type ----------------------------------------------------------------------

def hits(df, predicates):
    return [len(r[0]) for r in df.select(slices_of(predicates)).collect()]


@QUICK
@given(st.lists(st.one_of(st.none(), st.dates(date(2020, 1, 1), date(2020, 3, 1))), min_size=1, max_size=30),
       st.lists(st.dates(date(2020, 1, 1), date(2020, 3, 1)), max_size=5, unique=True))
def test_every_date_lies_in_one_slice(spark, values, edges):
    df = spark.createDataFrame([(v,) for v in values], "k date")
    assert set(hits(df, range_predicates("k", sorted(edges)))) == {1}


TEXTS = st.text("ab'\"% é-", max_size=4)
STAMPS = st.datetimes(datetime(2020, 1, 1), datetime(2020, 1, 2))


@QUICK
@given(st.lists(st.tuples(st.one_of(st.none(), TEXTS), st.one_of(st.none(), STAMPS)), min_size=1, max_size=25), st.integers(1, 6))
def test_every_pair_lies_in_one_slice(spark, rows, n):
    df = spark.createDataFrame(rows, "a string, b timestamp_ntz")
    cuts = sorted(set(r for r in rows if None not in r))[::n]
    assert set(hits(df, tuple_predicates(["a", "b"], cuts))) == {1}


def test_cuts_of_sorted_tuples_are_even(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k'"), (F.col("id") % 50).cast("string"))).alias("a"), F.col("id").alias("b"))
    cuts = sorted_cuts(df, ["a", "b"], 8)
    assert len(cuts) == 7 and cuts == sorted(cuts)
    predicates = tuple_predicates(["a", "b"], cuts)
    assert set(hits(df, predicates)) == {1}
    sizes = [df.filter(p).count() for p in predicates]
    assert sum(sizes) == 6000 and max(sizes) < 2 * 6000 / 8
    assert sorted_cuts(df.limit(0), ["a", "b"], 8) == [] and sorted_cuts(df, ["a"], 1) == []


def test_no_row_without_a_salt_is_lost(spark):
    df = spark.createDataFrame([(7, s) for s in (None, 0, 1, -1, -2, 5, -(2**63), 2**63 - 1)] + [(None, 1), (3, None), (9, 2)], "k int, s long")
    assert set(hits(df, skewed_predicates("k", [7, 7, 7], "s"))) == {1}
    assert set(hits(df, skewed_predicates("k", [3, 7, 7, 9, 9], "s"))) == {1}


def test_literals():
    assert [literal(v) for v in (1, Decimal("1E+2"), date(2024, 1, 2), datetime(2024, 1, 2, 3), "it's")] == [
        "1", "100", "DATE '2024-01-02'", "TIMESTAMP '2024-01-02 03:00:00'", "'it''s'"]
    for bad, error in (("back\\slash", ValueError), (b"x", TypeError)):
        with pytest.raises(error):
            literal(bad)


# --- replacing folders ---------------------------------------------------------------------------

class Refusing:
    """A file system that refuses some renames."""

    def __init__(self, fs, refuse):
        self.fs, self.refuse = fs, refuse

    def __getattr__(self, name):
        return getattr(self.fs, name)

    def rename(self, source, target):
        return False if self.refuse(source.toString(), target.toString()) else self.fs.rename(source, target)


@pytest.mark.parametrize("refuse, left", [
    (lambda s, t: "__new_" in s, 5),  # the new folder cannot be put in place: the old one is moved back
    (lambda s, t: "__old_" in t, 5),  # the old folder cannot be moved aside
])
def test_no_version_is_lost_when_a_rename_is_refused(spark, tmp_path, monkeypatch, refuse, left):
    path = str(tmp_path / "t")
    sink.overwrite_parquet(spark.range(5), path)
    plain = session_module.file_system
    monkeypatch.setattr(session_module, "file_system", lambda s, p: (Refusing(plain(s, p)[0], refuse), plain(s, p)[1]))
    with pytest.raises(OSError):
        sink.overwrite_parquet(spark.range(9), path)
    assert spark.read.parquet(path).count() == left
    kept, = tmp_path.glob("t__new_*")
    assert spark.read.parquet(str(kept)).count() == 9


def test_a_crash_between_the_moves_is_put_right(spark, tmp_path):
    path = tmp_path / "t"
    sink.overwrite_parquet(spark.range(5), str(path))
    path.rename(tmp_path / "t__old_1")
    with pytest.raises(Exception):
        sink.overwrite_parquet(spark.range(9).select(F.assert_true(F.col("id") < 7).cast("string"), "id"), str(path))
    assert spark.read.parquet(str(path)).count() == 5
    sink.overwrite_parquet(spark.range(9), str(path))
    assert spark.read.parquet(str(path)).count() == 9 and len(list(tmp_path.iterdir())) == 1


def test_a_stage_left_by_a_crash_does_not_matter(spark, tmp_path):
    (tmp_path / "stage" / "run-1").mkdir(parents=True)
    (tmp_path / "stage" / "mine.txt").write_text("x")
    job = CopyJob("t", lambda s: s.range(3).toDF("id"), lambda df: sink.overwrite_parquet(df, f"{tmp_path}/t"), stage=str(tmp_path / "stage"))
    for _ in range(2):
        assert copy_table(spark, job).rows_out == 3
    assert sorted(p.name for p in (tmp_path / "stage").iterdir()) == ["mine.txt", "run-1"]


# --- error budget over a stream ------------------------------------------------------------------

def stop_of(flags, budget, least):
    """(rows, bad rows, stop) before the row that breaks the budget."""
    bad = 0
    for at, flag in enumerate(flags):
        now = bad + flag
        over = budget.records is not None and now > budget.records
        over |= budget.share is not None and at + 1 >= least and now > (at + 1) * budget.share
        if flag and over:
            return at, bad, at
        bad = now
    return len(flags), bad, None


@pytest.mark.parametrize("records, share", [(9, None), (None, 0.12), (1000, 0.9), (0, 0.5)])
def test_the_stop_does_not_depend_on_the_batches(spark, tmp_path, records, share):
    rng, limits = random.Random(4), ErrorBudget(records, share)
    flags = [rng.random() < (0.05 if at < 150 else 0.3) for at in range(260)]
    expected = stop_of(flags, limits, 20)
    for trial, cuts in enumerate(([0, 260], [0, 10, 90, 91, 200, 260], list(range(0, 261, 65)))):
        root = f"{tmp_path}/{trial}"
        for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
            rows = spark.createDataFrame([(at, ["r"] if flags[at] else []) for at in range(a, b)], f"seq long, {REASONS} array<string>").repartition(3)
            try:
                for _ in range(2):  # a batch tried again changes nothing
                    budget.apply_batch(rows, number, root, "seq", limits, least=20, block=16)
            except BudgetExceeded:
                break
        found = budget.totals(spark, root)
        assert (found.total, found.bad, found.stopped_at) == expected
        good, bad = (budget.good_rows(spark, root, part).count() for part in ("rows", "rejects"))
        assert (good, bad) == (expected[0] - expected[1], expected[1])


def test_a_stopped_stream_stays_stopped_until_it_is_resumed(spark, tmp_path):
    def rows(first, flags):
        return spark.createDataFrame([(first + i, ["r"] if f else []) for i, f in enumerate(flags)], f"seq long, {REASONS} array<string>")

    root, none = str(tmp_path), ErrorBudget(0, None)
    budget.apply_batch(rows(0, [0, 0]), 0, root, "seq", none)
    for _ in range(2):
        with pytest.raises(BudgetExceeded):
            budget.apply_batch(rows(2, [0, 1, 0]), 1, root, "seq", none)
    with pytest.raises(BudgetExceeded):
        budget.apply_batch(rows(5, [0]), 2, root, "seq", none)
    assert budget.totals(spark, root) == budget.Totals(3, 0, 3)
    budget.resume(spark, root)
    assert budget.apply_batch(rows(2, [0, 1, 0]), 1, root, "seq", ErrorBudget(1, None)) == budget.Totals(5, 1, None)
    with pytest.raises(Exception, match="without a position"):
        budget.apply_batch(spark.createDataFrame([(None, [])], f"seq long, {REASONS} array<string>"), 2, root, "seq", none)


# --- clustered tables ----------------------------------------------------------------------------

def test_a_point_filter_opens_few_files(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 50).when(F.col("id") % 997 != 0, F.col("id") % 100).alias("k"), F.col("id").alias("cut"), F.lit("x").alias("v"))
    files = clustered.save_clustered(rows, str(tmp_path), ["k", "cut"], rows_per_file=1000)
    assert files >= 18
    sizes = [r["n"] for r in spark.read.parquet(f"{tmp_path}/_files").collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 2000  # the hot key is cut
    for low, high, most in ((7, 7, 2), (50, 50, 10), (None, 3, 3), (98, None, 3), (200, 300, 0), (10, 20, 5)):
        wanted = F.col("k").isNotNull()
        if low is not None:
            wanted &= F.col("k") >= low
        if high is not None:
            wanted &= F.col("k") <= high
        got = clustered.read_between(spark, str(tmp_path), "k", low, high)
        assert len(clustered.files_between(spark, str(tmp_path), "k", low, high)) <= most
        assert got.count() == rows.filter(wanted).count() == got.filter(wanted).count()


def test_the_driver_sees_tasks_not_files(spark, tmp_path, monkeypatch):
    """400 files are written by a few tasks, each a range of its own; before, every file was a task and 100 rows of the driver's sample."""
    monkeypatch.setattr(clustered, "ROWS_PER_TASK", 10_000, raising=False)
    rows, asked = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("k")), []
    ranges = type(rows).repartitionByRange
    monkeypatch.setattr(type(rows), "repartitionByRange", lambda self, n, *by: asked.append(n) or ranges(self, n, *by))
    files = clustered.save_clustered(rows, str(tmp_path), ["k"], rows_per_file=100)
    assert 400 <= files <= 400 + asked[0] and asked[0] <= max(4, 3 * spark.sparkContext.defaultParallelism)
    index = sorted((r["low"]["k"], r["high"]["k"], r["n"]) for r in spark.read.parquet(f"{tmp_path}/_files").collect())
    assert all(a[1] < b[0] for a, b in zip(index, index[1:])) and max(n for *_, n in index) <= 100 and sum(n for *_, n in index) == 40_000
    assert sorted(r["k"] for r in clustered.read_between(spark, str(tmp_path), "k", 950, 1249).collect()) == list(range(950, 1250))


# --- flush by count or time ----------------------------------------------------------------------

def brute_flushes(rows, most, seconds):
    """(key, number, reason, payloads) that a later row ends; rows are (key, payload, at) in the order of their time."""
    found, held, number = [], {}, Counter()
    for key, payload, at in rows:
        own = held.setdefault(key, [])
        if own and at >= own[0][1] + timedelta(seconds=seconds):
            found.append((key, number[key], "time", [p for p, _ in own]))
            number[key] += 1
            own.clear()
        own.append((payload, at))
        if len(own) == most:
            found.append((key, number[key], "count", [p for p, _ in own]))
            number[key] += 1
            own.clear()
    return found, {k: [p for p, _ in v] for k, v in held.items() if v}


def flushed(spark, path):
    rows = spark.read.schema(flush.FLUSHES).parquet(path).collect()
    return sorted((r["key"], r["flush_no"], r["reason"], r["payloads"]) for r in rows)


def test_flushes_end_by_count_or_time_also_after_a_restart(spark, tmp_path):
    rng, now, rows = random.Random(6), datetime(2024, 1, 1), []
    for i in range(120):
        now += timedelta(seconds=rng.choice([10, 20, 400]))
        rows.append((rng.choice("ab"), f"{i:04}", now))
    schema = "k string, p string, t timestamp"
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "checkpoint"))

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
        found = flush.count_or_time_flush(stream, F.col("k"), F.col("p"), "t", rows=6, seconds=600)
        found.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()

    for part, (a, b) in enumerate(((0, 35), (35, 36), (36, 120))):
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.mode("append").parquet(feed)
        run()  # each run is a restart from the checkpoint
        assert flushed(spark, out) == sorted(brute_flushes(rows[:b], 6, 600)[0])
    assert {r for _, _, r, _ in flushed(spark, out)} == {"count", "time"}


def test_a_flush_query_over_what_is_there_ends(spark, tmp_path):
    """Also with rows left waiting, of a key that is NULL too; a second run on the same checkpoint adds nothing."""
    schema = "k string, p string, t timestamp"
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    rows = [(k, str(i), datetime(2024, 1, 1)) for k in ("a", None) for i in range(5)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(feed)
    for _ in range(2):
        found = flush.count_or_time_flush(spark.readStream.schema(schema).parquet(feed), F.col("k"), F.col("p"), "t", rows=3, seconds=600)
        query = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out)
        try:
            assert query.awaitTermination(120)
        finally:
            query.stop()
        assert {(r["key"], r["flush_no"], r["reason"], *r["payloads"]) for r in spark.read.schema(flush.FLUSHES).parquet(out).collect()} == {
            ("a", 0, "count", "0", "1", "2"), (None, 0, "count", "0", "1", "2")}


def test_what_waits_is_handed_on_by_the_clock(spark, tmp_path):
    schema = "k string, p string, t timestamp"
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    spark.createDataFrame([("a", "1", datetime(2024, 1, 1))], schema).coalesce(1).write.parquet(feed)
    stream = spark.readStream.schema(schema).parquet(feed)
    found = flush.count_or_time_flush(stream, F.col("k"), F.col("p"), "t", rows=100, seconds=1)
    query = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="200 milliseconds").start(out)
    try:
        for _ in range(60):
            if (tmp_path / "out").exists() and flushed(spark, out):
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert flushed(spark, out) == [("a", 0, "time", ["1"])]


def test_flush_query(spark, folder):
    events = sorted((r["event_type"], f"{r['event_id']:012}", r["ts"]) for r in spark.read.parquet(f"{folder}/events.parquet").collect())
    events.sort(key=lambda r: r[2])
    rows = load_queries.QUERIES["stream_count_or_time_flush"](spark, folder).collect()
    got = sorted((r["key"], r["flush_no"], r["reason"], r["payloads"]) for r in rows)
    assert got == sorted(brute_flushes(events, 20, 12 * 3600)[0])


# --- the same as JSON ----------------------------------------------------------------------------

def test_json_copies_know_earlier_keys(spark, tmp_path):
    def run(rows):
        spark.createDataFrame(rows, "id int, t int").write.mode("overwrite").parquet(f"{tmp_path}/source")
        job = {
            "name": "t", "source": {"kind": "parquet", "path": f"{tmp_path}/source"}, "sink": {"kind": "slices", "path": f"{tmp_path}/rows"},
            "keys": [{"name": "PRIMARY", "columns": ["id"], "primary": True}], "budget": {"records": None, "share": 1.0},
            "incremental": {"column": "t", "marks": f"{tmp_path}/marks"}, "key_index": f"{tmp_path}/index",
        }
        (tmp_path / "jobs.json").write_text(json.dumps({"copies": [job]}))
        row = run_copies(spark, str(tmp_path / "jobs.json")).first()
        return row["status"], row["rows_out"], row["rejected"]

    assert run([(1, 1), (2, 2)]) == ("success", 2, 0)
    assert run([(1, 1), (2, 2), (2, 3), (3, 4)]) == ("success", 1, 1)


def test_json_summary_stream(spark, tmp_path):
    lines = [
        {"seq": i, "kind": "insert", "db": "d", "tbl": "sales", "rows": [{"values": {"id": i, "amount": "1.50", "time": f"2024-01-0{i}T10:00:00"}}]}
        for i in (1, 2, 3)
    ]
    lines.append({"seq": 4, "kind": "delete", "db": "d", "tbl": "sales", "rows": [{"values": {"id": 3, "amount": "1.50", "time": "2024-01-03T10:00:00"}}]})
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.txt").write_text("\n".join(map(json.dumps, [*lines, lines[0]])))
    image = "struct<id: int, amount: decimal(10,2), time: timestamp_ntz>"
    config = {
        "source": {"kind": "files", "path": str(tmp_path / "feed"),
                   "schema": f"seq long, kind string, db string, tbl string, rows array<struct<values: {image}, before_values: {image}, after_values: {image}>>"},
        "flow": {"kind": "summary", "root": str(tmp_path / "state"),
                 "summary": {"group": {"day": "CAST(time AS DATE)"}, "sums": {"amount": "amount"}, "unit": "date_format(time, 'yyyy-MM')"}},
    }
    (tmp_path / "stream.json").write_text(json.dumps(config))
    start_stream(spark, str(tmp_path / "stream.json")).awaitTermination()
    schema = StructType.fromDDL("unit string, day date, row_cnt bigint, amount decimal(38,2)")
    got = summaries.current_summary(spark, str(tmp_path / "state"), schema).orderBy("day").collect()
    assert [(str(r["day"]), r["row_cnt"], r["amount"]) for r in got] == [("2024-01-01", 1, Decimal("1.50")), ("2024-01-02", 1, Decimal("1.50"))]
