"""Digests of a table by key range, in a tree: two versions are compared without rereading what did not change.

A digest says how many rows a range of keys has and, free of their order, what they hold: two sums (modulo 2**40) and an exclusive or of
64-bit row hashes. Digests of neighbouring ranges add up, so the upper levels come from the lowest without touching a row. A tree is a
small table beside its version; two trees are compared from the top, and only ranges that differ are followed down
and, at the bottom, read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

#: Digests in a node of the next level; sums are kept below this.
FANOUT, MODULUS = 16, 1 << 40
#: At most so many ranges are named one by one in the filter of a read; more are joined as a table.
MOST_RANGES = 400
TREE = "level int, cell long, n long, low long, high long, mixed long"


@dataclass(frozen=True)
class Ranges:
    """How keys are cut: the leading key column (a whole number), the width of the lowest ranges, all key columns."""

    column: str
    width: int
    keys: tuple[str, ...]


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


#: The cell of rows without a leading key, below all others.
NO_KEY = -(1 << 62)


def _floor_div(value: Column, by: int) -> Column:
    """Whole division that rounds down, exact for all whole numbers (a plain division goes through doubles)."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def cell_of(ranges: Ranges) -> Column:
    """The lowest range a row's leading key lies in; NULL has a range of its own."""
    return F.coalesce(_floor_div(_name(ranges.column).cast("long"), ranges.width), F.lit(NO_KEY))


def above(cell: Column) -> Column:
    """The cell of the next level."""
    return F.when(cell == NO_KEY, cell).otherwise(_floor_div(cell, FANOUT))


def row_hash(columns: list[str]) -> Column:
    """A 64-bit hash of the whole row. NULLs are marked, since Spark's hash passes over them."""
    values = [part for c in sorted(columns) for part in (_name(c).isNull(), _name(c))]
    return F.xxhash64(*values)


def leaf_digests(df: DataFrame, ranges: Ranges) -> DataFrame:
    """The lowest level: one pass over the table that shuffles a row per task and range, whatever the ranges hold."""
    hashed = df.select(cell_of(ranges).alias("cell"), row_hash(df.columns).alias("hash"))
    low, high = F.col("hash").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("hash", 32)
    grouped = hashed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.pmod(F.sum(low), F.lit(MODULUS)).alias("low"),
        F.pmod(F.sum(high), F.lit(MODULUS)).alias("high"), F.bit_xor("hash").alias("mixed"),
    )
    return grouped.select(F.lit(0).alias("level"), "cell", "n", "low", "high", "mixed")


def next_level(digests: DataFrame, level: int) -> DataFrame:
    """The level above: FANOUT ranges become one."""
    return digests.groupBy(above(F.col("cell")).alias("cell")).agg(
        F.sum("n").alias("n"), F.pmod(F.sum("low"), F.lit(MODULUS)).alias("low"), F.pmod(F.sum("high"), F.lit(MODULUS)).alias("high"),
        F.bit_xor("mixed").alias("mixed"),
    ).select(F.lit(level).alias("level"), "cell", "n", "low", "high", "mixed")


def write_tree(df: DataFrame, ranges: Ranges, path: str) -> int:
    """Writes the digest tree of a table below `path`, a folder a level, up to one of at most FANOUT ranges; returns the top level."""
    spark, level = df.sparkSession, 0
    leaf_digests(df, ranges).write.mode("overwrite").parquet(f"{path}/level=0")
    while spark.read.schema(TREE).parquet(f"{path}/level={level}").count() > FANOUT:  # counts come from file footers
        level += 1
        below = spark.read.schema(TREE).parquet(f"{path}/level={level - 1}")
        next_level(below, level).write.mode("overwrite").parquet(f"{path}/level={level}")
        if spark.read.parquet(f"{path}/level={level}").count() == below.count():
            break  # keys too far apart to meet
    return level


def _level(spark, path: str, level: int, top: int, ranges: Ranges) -> DataFrame:
    """A level of a tree; above its own top it is made from the top."""
    digests = spark.read.schema(TREE).parquet(f"{path}/level={min(level, top)}")
    for up in range(top + 1, level + 1):
        digests = next_level(digests, up)
    return digests


def differing_cells(spark, left: str, right: str, tops: tuple[int, int], ranges: Ranges) -> DataFrame:
    """(cell) of the lowest level in which two trees differ: a level is compared only below what differed above it."""
    wanted, top = None, max(tops)
    for level in range(top, -1, -1):
        sides = []
        for path, own_top in zip((left, right), tops):
            digests = _level(spark, path, level, own_top, ranges)
            if wanted is not None:
                digests = digests.join(wanted.select(F.col("cell").alias("_above")), above(F.col("cell")) == F.col("_above"), "left_semi")
            sides.append(digests.select("cell", F.struct("n", "low", "high", "mixed").alias("digest")))
        a, b = sides
        wanted = a.join(b.withColumnRenamed("digest", "other"), "cell", "full_outer").filter(
            ~F.col("digest").eqNullSafe(F.col("other"))
        ).select("cell")
    return wanted


def merged_ranges(cells: list[int], width: int) -> list[tuple[int, int]]:
    """Key ranges [from, to) of some cells, neighbours joined."""
    found: list[tuple[int, int]] = []
    for cell in sorted(cells):
        if found and found[-1][1] == cell * width:
            found[-1] = (found[-1][0], (cell + 1) * width)
        else:
            found.append((cell * width, (cell + 1) * width))
    return found


def rows_in(df: DataFrame, cells: DataFrame, ranges: Ranges) -> DataFrame:
    """The rows of some cells. A few are named as key ranges, which reach the scan, so that files and row groups outside them
    are not read; more than MOST_RANGES are joined."""
    listed = [r[0] for r in cells.limit(MOST_RANGES * FANOUT + 1).collect()]
    merged = merged_ranges([c for c in listed if c != NO_KEY], ranges.width)
    if len(listed) > MOST_RANGES * FANOUT or len(merged) > MOST_RANGES:
        return df.join(cells.select(F.col("cell").alias("_cell")), cell_of(ranges) == F.col("_cell"), "left_semi")
    key = _name(ranges.column)
    parts = [(key >= a) & (key < b) for a, b in merged] + ([key.isNull()] if NO_KEY in listed else [])
    return df.filter(reduce(or_, parts)) if parts else df.filter(F.lit(False))


def differences(old: DataFrame, new: DataFrame, ranges: Ranges) -> DataFrame:
    """(key columns, kind, n_old, n_new): keys whose rows differ, `insert`, `change` or `delete`.

    Rows are compared as whole rows; repeated keys count as a bag. Reads whatever it is given, so give it the rows of differing cells.
    """
    columns = old.columns

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*[_name(k) for k in ranges.keys], row_hash(columns).alias("_hash"), F.lit(sign).cast("long").alias("_sign"))

    both = side(old, -1).unionByName(side(new.select(*[_name(c) for c in columns]), 1))
    net = both.groupBy(*[_name(k) for k in ranges.keys], "_hash").agg(
        F.sum("_sign").alias("_net"), F.count_if(F.col("_sign") < 0).alias("_old"), F.count_if(F.col("_sign") > 0).alias("_new")
    )
    found = net.groupBy(*[_name(k) for k in ranges.keys]).agg(
        F.sum("_old").alias("n_old"), F.sum("_new").alias("n_new"), F.count_if(F.col("_net") != 0).alias("_off")
    ).filter("_off > 0")
    kind = F.when(F.col("n_old") == 0, "insert").when(F.col("n_new") == 0, "delete").otherwise("change")
    return found.select(*[_name(k) for k in ranges.keys], kind.alias("kind"), "n_old", "n_new")


def compare_versions(
    old: DataFrame, new: DataFrame, ranges: Ranges, old_tree: str, new_tree: str, tops: tuple[int, int]
) -> DataFrame:
    """The keys inserted, changed and deleted between two versions whose digest trees are stored.

    Reads the trees along the paths that differ, then of each version the rows of the differing ranges.
    """
    cells = differing_cells(old.sparkSession, old_tree, new_tree, tops, ranges)
    return differences(rows_in(old, cells, ranges), rows_in(new, cells, ranges), ranges)
