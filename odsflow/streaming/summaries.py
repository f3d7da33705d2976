"""Summaries kept up from row changes: a change adds its row as it is and takes away the row as it was.

Layout under `root`: `rows/batch_id=N/unit=U/` holds the summary rows of the units (such as months) that batch N touched, as they are after
it; `seen/` the positions of the feed that have come (see `operators.positions`). A batch's folder counts once its `_SUCCESS` is
there and is never rewritten, so a batch that is tried again changes nothing, and a crash leaves the state before it. The newest folder of a unit is its state.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from odsflow.operators.changes import normalise_changes
from odsflow.operators.positions import fresh, mark_seen, seen
from odsflow.session import child_names, delete_folder, path_exists
from odsflow.streaming.triggers import trigger_options

UNIT, COUNT = "unit", "row_cnt"
POSITION = "seq"


@dataclass(frozen=True)
class Summary:
    """What is summed: SQL expressions over a row's columns.

    `where` picks the rows, `group` names the columns of the groups, `sums` the numbers that are added up (NULL adds nothing; an
    exact type, so that what is taken away is what was added). `unit` is the coarser part of a group that is rewritten as one, as text.
    """

    group: dict[str, str]
    sums: dict[str, str]
    unit: str
    where: str = "true"


def deltas(changes: DataFrame, summary: Summary) -> DataFrame:
    """(unit, groups, row_cnt, sums) of what some normalised changes (old, new) add and take away; groups where nothing is left out.

    One shuffle of groups; a change within a group cancels out before it.
    """
    sides = F.filter(
        F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("row"))),
        lambda side: side["row"].isNotNull(),
    )
    rows = changes.select(F.explode(sides).alias("side")).select(F.col("side.sign").alias("_sign"), "side.row.*").filter(summary.where)
    named = [F.expr(e).alias(n) for n, e in summary.group.items()]
    numbers = [F.coalesce(F.expr(e), F.lit(0)).alias(n) for n, e in summary.sums.items()]
    rows = rows.select(F.expr(summary.unit).cast("string").alias(UNIT), *named, *numbers, "_sign")
    added = rows.groupBy(UNIT, *summary.group).agg(
        F.sum("_sign").cast("long").alias(COUNT), *[F.sum(F.col(n) * F.col("_sign")).alias(n) for n in summary.sums]
    )
    return added.filter(reduce(or_, [F.col(n) != 0 for n in (COUNT, *summary.sums)]))


def _merged(rows: DataFrame, summary: Summary, schema: StructType | None = None) -> DataFrame:
    """Summary rows of the same group added up; types stay those of `schema`."""
    types = {f.name: f.dataType for f in (schema or rows.schema).fields}
    return rows.groupBy(UNIT, *summary.group).agg(
        *[F.sum(n).cast(types[n]).alias(n) for n in (COUNT, *summary.sums)]
    ).select(*(schema or rows.schema).names)


def finished_batches(spark: SparkSession, root: str) -> list[int]:
    names = [n for n in child_names(spark, f"{root}/rows") if n.startswith("batch_id=")]
    return sorted(int(n.split("=", 1)[1]) for n in names if path_exists(spark, f"{root}/rows/{n}/_SUCCESS"))


def newest_units(spark: SparkSession, root: str, before: int | None = None) -> dict[str, int]:
    """The newest batch of each unit (its folder name) among the finished ones (before a given one)."""
    newest = {}
    for batch in finished_batches(spark, root):
        if before is None or batch < before:
            newest |= {n: batch for n in child_names(spark, f"{root}/rows/batch_id={batch}") if n.startswith(f"{UNIT}=")}
    return newest


def _stored(spark: SparkSession, root: str, schema: StructType, units: dict[str, int]) -> DataFrame:
    """The stored rows of some units; each batch's folder is read with its own units only."""
    parts = [spark.createDataFrame([], schema)]
    for batch in sorted(set(units.values())):
        folder = f"{root}/rows/batch_id={batch}"
        paths = [f"{folder}/{unit}" for unit, newest in units.items() if newest == batch]
        parts.append(spark.read.schema(schema).option("basePath", folder).parquet(*paths).select(*schema.names))
    return reduce(DataFrame.unionByName, parts)


def apply_deltas(added: DataFrame, root: str, batch_id: int, summary: Summary) -> list[str]:
    """Adds a batch's deltas to the stored summary; returns the units written (folder names). Other units are neither read nor written."""
    spark, folder = added.sparkSession, f"{root}/rows/batch_id={batch_id}"
    if not path_exists(spark, f"{folder}/_SUCCESS"):
        own = f"{root}/deltas/batch_id={batch_id}"
        added.write.mode("overwrite").parquet(own)
        added = spark.read.schema(added.schema).parquet(own)
        newest = newest_units(spark, root, batch_id)
        listed = added.select(UNIT).distinct().withColumn("folder", _folder_name())
        touched = {r["folder"] for r in listed.collect()}  # one row a unit
        known = _stored(spark, root, added.schema, {u: b for u, b in newest.items() if u in touched})
        rows = _merged(known.unionByName(added), summary, added.schema)
        rows.hint("rebalance", UNIT).write.mode("overwrite").partitionBy(UNIT).parquet(folder)
        delete_folder(spark, own)
    return sorted(n for n in child_names(spark, folder) if n.startswith(f"{UNIT}="))


def _folder_name() -> Column:
    """The folder of a unit. Units are plain words (digits, letters, dots, dashes, underscores), so that text and folder agree."""
    plain = F.col(UNIT).rlike(r"^[0-9A-Za-z._-]+$")
    return F.when(plain, F.concat(F.lit(f"{UNIT}="), F.col(UNIT))).otherwise(
        F.raise_error(F.concat(F.lit("a unit has to be a plain word: "), F.coalesce(UNIT, F.lit("NULL"))))
    )


def current_summary(spark: SparkSession, root: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The summary now: groups that have rows left. `schema` is that of `deltas`."""
    return _stored(spark, root, schema, newest_units(spark, root, before)).filter(F.col(COUNT) > 0)


def drop_superseded(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Deletes unit folders that a batch older than the last `keep` holds and a newer one replaced; readers still on them have time till then."""
    batches, newest, gone = finished_batches(spark, root), newest_units(spark, root), 0
    for batch in batches[:-keep] if keep else batches:
        folder = f"{root}/rows/batch_id={batch}"
        for unit in [n for n in child_names(spark, folder) if n.startswith(f"{UNIT}=") and newest[n] != batch]:
            delete_folder(spark, f"{folder}/{unit}")
            gone += 1
    return gone


def apply_feed(feed: DataFrame, batch_id: int, root: str, summary: Summary, databases=None, tables=None) -> list[str]:
    """One batch of a raw feed (see `operators.changes.normalise_changes`) into the summary.

    An event whose position came before, in this batch or an earlier one, is left out: a feed may deliver twice.
    """
    spark = feed.sparkSession
    before = seen(spark, f"{root}/seen", batch_id)
    own = fresh(feed.dropDuplicates([POSITION]), POSITION, before)
    units = apply_deltas(deltas(normalise_changes(own, databases, tables), summary), root, batch_id, summary)
    mark_seen(feed, POSITION, f"{root}/seen", batch_id)
    return units


def summarise_feed(
    feed: DataFrame, root: str, summary: Summary, databases: list[str] | None = None, tables: list[str] | None = None, seconds: int | None = None
) -> StreamingQuery:
    """Starts the upkeep of a summary from a raw change feed that begins with the empty table."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_feed(batch, batch_id, root, summary, databases, tables)

    return (
        feed.writeStream.foreachBatch(apply).option("checkpointLocation", f"{root}/_checkpoint").trigger(**trigger_options(seconds)).start()
    )
