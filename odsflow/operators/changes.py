"""Row changes: from a raw feed to readable records and to the latest state per key.

A change row has `op` (I, U or D), the sequence columns that order it, and the table's columns.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("insert", "update", "delete")
OPS = {"insert": "I", "update": "U", "delete": "D"}
#: Without it Spark leaves NULL fields out.
ALL_FIELDS = {"ignoreNullFields": "false"}
ALERT_NAMES = {"I": "INSERT", "U": "UPDATE", "D": "DELETE"}


def _lookup(values: dict[str, str], key: Column) -> Column:
    pairs = [F.lit(part) for pair in values.items() for part in pair]
    return F.element_at(F.create_map(*pairs), key)


def from_json_lines(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Messages held as JSON text, as rows. A message that is no JSON stops the load: passing over
    it would lose a change unseen."""
    parsed = F.from_json(F.col(column), schema, {"mode": "FAILFAST"})
    return lines.select(parsed.alias("_row")).select("_row.*")


def normalise_changes(
    feed: DataFrame,
    databases: list[str] | None = None,
    tables: list[str] | None = None,
    kinds: list[str] | tuple[str, ...] = KINDS,
) -> DataFrame:
    """One row per changed row: op, database, table, seq, row_no, old, new.

    Feed: kind, db, tbl, seq, rows: array<struct<values, before_values, after_values>>. An insert has
    `new`, a delete `old`, an update both. `row_no` orders the rows inside one event. An event
    without rows gives one row with neither and a NULL `row_no`, so that it can be counted.
    """
    wanted = F.col("kind").isin(list(kinds))
    if databases:
        wanted = wanted & F.col("db").isin(list(databases))
    if tables:
        wanted = wanted & F.col("tbl").isin(list(tables))
    rows = feed.filter(wanted).select("kind", "db", "tbl", "seq", F.posexplode_outer("rows").alias("row_no", "row"))
    kind, row = F.col("kind"), F.col("row")
    return rows.select(
        _lookup(OPS, kind).alias("op"),
        "db",
        "tbl",
        "seq",
        "row_no",
        F.when(kind == "update", row["before_values"]).when(kind == "delete", row["values"]).alias("old"),
        F.when(kind == "update", row["after_values"]).when(kind == "insert", row["values"]).alias("new"),
    )


def to_changes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Normalised rows as key changes with flat columns.

    An update that moves a row to another key becomes a delete of the old key and an update of the
    new one, both with the same sequence. Events without rows change nothing.
    """
    rows = rows.filter(F.col("old").isNotNull() | F.col("new").isNotNull())
    moved = F.lit(False)
    for key in keys:
        moved = moved | ~F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}"))
    removed = F.struct(F.lit("D").alias("op"), F.col("old").alias("data"))
    kept = F.struct(F.col("op").alias("op"), F.coalesce("new", "old").alias("data"))
    parts = F.when((F.col("op") == "U") & moved, F.array(removed, kept)).otherwise(F.array(kept))
    return rows.select("seq", "row_no", F.explode(parts).alias("part")).select(
        "part.op", "seq", "row_no", "part.data.*"
    )


def alerts(rows: DataFrame) -> DataFrame:
    """Normalised rows as readable records: event_type, database, table and the data as JSON text.

    Fields that are NULL stay in the JSON as null.
    """
    old, new, both = (F.to_json(c, ALL_FIELDS) for c in ("old", "new", F.struct(F.col("old"), F.col("new"))))
    return rows.select(
        _lookup(ALERT_NAMES, F.col("op")).alias("event_type"),
        "db",
        "tbl",
        "seq",
        "row_no",
        F.when(F.col("op") == "U", both).otherwise(F.coalesce(new, old)).alias("data"),
    )


def latest_per_key(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last change of every key, deletes included.

    The largest struct led by the order columns: it reduces on the map side, so one hot key costs one
    row per task in the shuffle, and equal sequences still give the same row on every run.
    """
    rest = [c for c in changes.columns if c not in keys and c not in order]
    return (
        changes.groupBy(*keys)
        .agg(F.max(F.struct(*order, *rest)).alias("_last"))
        .select(*keys, "_last.*")
        .select(*changes.columns)
    )


def live_rows(state: DataFrame) -> DataFrame:
    """The rows that exist now: tombstones left out."""
    return state.filter(F.col("op") != "D")


def latest_state(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return live_rows(latest_per_key(changes, keys, order))


def _same(keys: list[str], other: str) -> Column:
    """Equal keys, NULL counting as a value, as it does in a grouping."""
    return reduce(and_, [F.col(key).eqNullSafe(F.col(f"{other}.{key}")) for key in keys])


def merge_state(base: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """State after the changes; both sides hold one row per key, tombstones included.

    A change wins only with a later sequence, so replays and late older updates alter nothing.
    Written as joins towards the changes: while those are below Spark's broadcast limit the big
    base is read in place and not shuffled; above it Spark sort-merges.
    """
    columns = base.columns
    change = changes.select(F.struct(*columns).alias("_change"))
    newer = F.col("_change").isNotNull() & (
        F.struct(*[F.col(f"_change.{c}") for c in order]) > F.struct(*[F.col(c) for c in order])
    )
    kept = base.join(change, _same(keys, "_change"), "left").select(
        *[F.when(newer, F.col(f"_change.{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )
    change_keys = changes.select(F.struct(*keys).alias("_key"))
    known = base.select(*keys).join(change_keys, _same(keys, "_key"), "left_semi")
    known_keys = known.select(F.struct(*keys).alias("_key"))
    added = changes.select(*columns).join(known_keys, _same(keys, "_key"), "left_anti")
    return kept.unionByName(added)
