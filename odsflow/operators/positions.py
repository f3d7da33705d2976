"""Which positions of a change feed have come: gaps and repeats, over any number of batches.

A feed numbers its events. What came is kept as boundaries, rows (position, step): the number of times a position came rises by `step`
there. Neighbours that came equally often cancel out, so a clean feed of any length is two rows, and boundaries of
several batches are just added up. Their running sum gives the runs: maximal ranges of positions that came equally often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from odsflow.session import child_names, path_exists

#: Positions in one block of the running sum; each block is summed by itself.
BLOCK = 1 << 20
#: The same where whole events are put in order.
FRESH_BLOCK = 1 << 16
BOUNDARIES = "feed string, position long, step long"
RUNS = "feed string, first_seq long, last_seq long, times long"


def boundaries(events: DataFrame, position: str, feed: Column | None = None) -> DataFrame:
    """(feed, position, step) of some events. `feed` tells apart feeds that number their events on their own (partitions, log files).

    Events without a position have no place and are left out; count them apart.
    """
    own = events.select((F.lit("") if feed is None else feed.cast("string")).alias("feed"), F.col(position).cast("long").alias("position"))
    own = own.filter(F.col("position").isNotNull())
    steps = F.array(F.struct(F.col("position"), F.lit(1).cast("long").alias("step")),
                    F.struct((F.col("position") + 1).alias("position"), F.lit(-1).cast("long").alias("step")))
    return added(own.select("feed", F.inline(steps)))


def added(rows: DataFrame) -> DataFrame:
    """Boundaries added up; those that cancel out are gone."""
    return rows.groupBy("feed", "position").agg(F.sum("step").alias("step")).filter("step <> 0")


def runs(steps: DataFrame, block: int = BLOCK) -> DataFrame:
    """(feed, first_seq, last_seq, times) from the first position to the last: `times` is 0 in a gap.

    `steps` are added up. Sums and next positions are taken block by block; over the blocks themselves run
    windows of one row a block that has boundaries.
    """
    cut = steps.withColumn("block", F.floor(F.col("position") / block))
    totals = cut.groupBy("feed", "block").agg(F.sum("step").alias("total"), F.min("position").alias("first"))
    ordered = Window.partitionBy("feed").orderBy("block")
    outside = totals.select(
        "feed", "block", F.coalesce(F.sum("total").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.lead("first").over(ordered).alias("behind"),
    )
    inside = Window.partitionBy("feed", "block").orderBy("position")
    times = F.sum("step").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = cut.select("feed", "block", "position", times.alias("times"), F.lead("position").over(inside).alias("next"))
    found = found.join(outside, ["feed", "block"])
    end = F.coalesce("next", "behind")
    return found.select(
        "feed", F.col("position").alias("first_seq"), (end - 1).alias("last_seq"), (F.col("times") + F.col("before")).alias("times")
    ).filter(F.col("last_seq").isNotNull())


def gaps_and_repeats(found: DataFrame) -> DataFrame:
    """The runs that need a look: kind (`gap` or `repeat`), first and last position, how often each came."""
    kind = F.when(F.col("times") == 0, "gap").when(F.col("times") > 1, "repeat")
    return found.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select("feed", "kind", "first_seq", "last_seq", "times")


# --- positions seen by the batches of a stream ---------------------------------------------------

def _finished(spark: SparkSession, root: str, prefix: str) -> list[int]:
    """Numbers of the complete `prefix=N` folders, ascending."""
    names = [n for n in child_names(spark, root) if n.startswith(f"{prefix}=") and path_exists(spark, f"{root}/{n}/_SUCCESS")]
    return sorted(int(n.split("=", 1)[1]) for n in names)


def mark_seen(events: DataFrame, position: str, root: str, batch_id: int, feed: Column | None = None) -> None:
    """Stores what positions a batch brought; a batch that is tried again replaces its own."""
    boundaries(events, position, feed).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def seen(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """Boundaries of all batches (or of those before one), added up: the newest fold and the batches behind it."""
    folds = [n for n in _finished(spark, root, "upto") if before is None or n < before]
    batches = [n for n in _finished(spark, root, "batch_id") if (not folds or n > folds[-1]) and (before is None or n < before)]
    folders = [f"{root}/upto={n}" for n in folds[-1:]] + [f"{root}/batch_id={n}" for n in batches]
    if not folders:
        return spark.createDataFrame([], BOUNDARIES)
    return added(spark.read.schema(BOUNDARIES).parquet(*folders))


def fold_seen(spark: SparkSession, root: str) -> int | None:
    """Writes the sum of all finished batches under the last one's number; the folders below stay for readers still on them."""
    batches = _finished(spark, root, "batch_id")
    if not batches or batches[-1] in _finished(spark, root, "upto"):
        return None
    seen(spark, root).write.mode("overwrite").parquet(f"{root}/upto={batches[-1]}")
    return batches[-1]


def fresh(events: DataFrame, position: str, steps: DataFrame, feed: Column | None = None, block: int = FRESH_BLOCK) -> DataFrame:
    """The events whose position the boundaries do not hold. An event without a position is always fresh.

    Events and boundaries are put in one order, block by block, and the running sum of the steps up to an event is the number of times its
    position came; so the work grows with their number, however many runs they make.
    """
    name, place = F.lit("") if feed is None else feed.cast("string"), F.col(position).cast("long")
    unplaced = name.isNull() | place.isNull()
    asked = events.filter(~unplaced).select(name.alias("feed"), place.alias("position"), F.struct("*").alias("_event"), F.lit(0).cast("long").alias("step"))
    held = steps.filter("feed IS NOT NULL").select("feed", "position", F.lit(None).cast(asked.schema["_event"].dataType).alias("_event"), "step")
    both = asked.unionByName(held).withColumn("block", F.floor(F.col("position") / block))
    totals = steps.withColumn("block", F.floor(F.col("position") / block)).groupBy("feed", "block").agg(F.sum("step").alias("total"))
    asked_blocks = asked.select("feed", F.floor(F.col("position") / block).alias("block")).distinct().withColumn("total", F.lit(0).cast("long"))
    earlier = Window.partitionBy("feed").orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
    before = totals.unionByName(asked_blocks).withColumn("before", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    before = before.groupBy("feed", "block").agg(F.max("before").alias("before")).filter("before <> 0")
    inside = Window.partitionBy("feed", "block").orderBy("position").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = both.withColumn("times", F.sum("step").over(inside)).filter("_event IS NOT NULL")
    new = counted.join(before, ["feed", "block"], "left").filter(F.col("times") + F.coalesce("before", F.lit(0)) <= 0)
    return new.select("_event.*").unionByName(events.filter(unplaced))
