"""An error budget over a stream: it stops before the row that would break it, wherever the batches end.

Rows come with a position that rises from batch to batch, and with the rules they break (`operators.quality.REASONS`). The running numbers of
rows and bad rows, in the order of the positions, decide; so the same feed stops at the same row however it is cut into batches. Layout under
`root`: `rows/batch_id=N` and `rejects/batch_id=N`, `counts/batch_id=N` (written last: what a batch brought), `stop` once the budget
is broken. A batch that is tried again replaces all of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from odsflow.operators.quality import REASONS, BudgetExceeded, ErrorBudget, is_bad
from odsflow.session import child_names, delete_folder, path_exists
from odsflow.streaming.triggers import trigger_options

COUNTS = "total long, bad long, last long"
STOP = "position long, total long, bad long, batch_id long"
#: Positions in one block of the running counts.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Totals:
    """Rows taken, bad ones among them, and the position that broke the budget (None while it holds)."""

    total: int
    bad: int
    stopped_at: int | None = None


def breaks(total: Column, bad: Column, budget: ErrorBudget, least: int) -> Column:
    """Whether running counts break the budget; a share counts from `least` rows on."""
    broken = [F.lit(False)]
    if budget.records is not None:
        broken.append(bad > budget.records)
    if budget.share is not None:
        broken.append((total >= least) & (bad > total * budget.share))
    return reduce(or_, broken)


def running_counts(rows: DataFrame, position: str, before: Totals, block: int = BLOCK) -> DataFrame:
    """(position, total, bad) at every bad row: rows and bad rows up to and with it. Rows of one position count together.

    Positions are summed first, then block by block; over the blocks runs a window of one row a block.
    """
    at = rows.groupBy(F.col(position).cast("long").alias("position")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_bad()).alias("b")
    ).withColumn("block", F.floor(F.col("position") / block))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = at.groupBy("block").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).select(
        "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"), F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("b_before"),
    )
    inside = Window.partitionBy("block").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = at.withColumns({"total": F.sum("n").over(inside), "bad": F.sum("b").over(inside)}).filter("b > 0").join(blocks, "block")
    return summed.select(
        "position", (F.col("total") + F.col("n_before") + before.total).alias("total"), (F.col("bad") + F.col("b_before") + before.bad).alias("bad")
    )


def finished_counts(spark: SparkSession, root: str, before: int | None = None) -> list[str]:
    names = [n for n in child_names(spark, f"{root}/counts") if n.startswith("batch_id=") and path_exists(spark, f"{root}/counts/{n}/_SUCCESS")]
    return [f"{root}/counts/{n}" for n in names if before is None or int(n.split("=", 1)[1]) < before]


def totals(spark: SparkSession, root: str, before: int | None = None) -> Totals:
    """What all batches (or those before one) have brought."""
    folders, stop = finished_counts(spark, root, before), None
    if before is None and path_exists(spark, f"{root}/stop/_SUCCESS"):
        stop = spark.read.schema(STOP).parquet(f"{root}/stop").first()["position"]
    if not folders:
        return Totals(0, 0, stop)
    row = spark.read.schema(COUNTS).parquet(*folders).agg(F.sum("total").alias("total"), F.sum("bad").alias("bad")).first()
    return Totals(row["total"], row["bad"], stop)


def apply_batch(
    rows: DataFrame, batch_id: int, root: str, position: str, budget: ErrorBudget, least: int = 1000, block: int = BLOCK
) -> Totals:
    """Stores a batch's good rows and rejects, up to the row that breaks the budget; in that case BudgetExceeded follows.

    Rows without a position cannot be placed and are an error. Once stopped, every later batch is refused until `resume`.
    """
    spark = rows.sparkSession
    stopped = spark.read.schema(STOP).parquet(f"{root}/stop").first() if path_exists(spark, f"{root}/stop/_SUCCESS") else None
    if stopped and stopped["batch_id"] != batch_id:
        raise BudgetExceeded(stopped["total"], stopped["bad"], budget)
    before = totals(spark, root, batch_id)
    placed = F.when(F.col(position).isNull(), F.raise_error(F.lit("a row without a position"))).otherwise(F.col(position))
    staged = f"{root}/staged/batch_id={batch_id}"  # a batch is read once, whatever its source
    rows.withColumn(position, placed.cast(rows.schema[position].dataType)).write.mode("overwrite").parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    broken = running_counts(rows, position, before, block).filter(breaks(F.col("total"), F.col("bad"), budget, least))
    first = broken.agg(F.min(F.struct("position", "total", "bad")).alias("first")).first()["first"]
    kept = rows if first is None else rows.filter(F.col(position) < first["position"])
    kept.filter(~is_bad()).drop(REASONS).write.mode("overwrite").parquet(f"{root}/rows/batch_id={batch_id}")
    kept.filter(is_bad()).write.mode("overwrite").parquet(f"{root}/rejects/batch_id={batch_id}")
    counted = kept.agg(F.count(F.lit(1)).alias("total"), F.count_if(is_bad()).alias("bad"), F.max(position).cast("long").alias("last"))
    if first is not None:
        stop = [(first["position"], first["total"], first["bad"], batch_id)]
        spark.createDataFrame(stop, STOP).coalesce(1).write.mode("overwrite").parquet(f"{root}/stop")
    counted.write.mode("overwrite").parquet(f"{root}/counts/batch_id={batch_id}")
    delete_folder(spark, staged)
    if first is not None:
        raise BudgetExceeded(first["total"], first["bad"], budget)
    return totals(spark, root)


def resume(spark: SparkSession, root: str) -> None:
    """Lifts a stop, after the source was mended or the budget raised: the batch that broke it is tried again, whole."""
    row = spark.read.schema(STOP).parquet(f"{root}/stop").first()
    delete_folder(spark, f"{root}/counts/batch_id={row['batch_id']}")
    delete_folder(spark, f"{root}/stop")


def good_rows(spark: SparkSession, root: str, part: str = "rows") -> DataFrame | None:
    """The good rows of all finished batches; the rejects with `part` rejects."""
    folders = [f.replace(f"{root}/counts/", f"{root}/{part}/") for f in finished_counts(spark, root)]
    return spark.read.parquet(*folders) if folders else None


def budgeted_stream(
    rows: DataFrame, root: str, position: str, budget: ErrorBudget, least: int = 1000, seconds: int | None = None
) -> StreamingQuery:
    """Starts a stream of checked rows under an error budget; the query fails with BudgetExceeded at the batch that breaks it."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, root, position, budget, least)

    return (
        rows.writeStream.foreachBatch(apply).option("checkpointLocation", f"{root}/_checkpoint").trigger(**trigger_options(seconds)).start()
    )
