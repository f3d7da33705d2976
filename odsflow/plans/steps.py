"""An ETL as configured steps over named views, and the daily order summary built that way."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Step:
    """A view name and what defines it: a SELECT text, or a function from the session to a frame."""

    view: str
    sql: str | Callable[[SparkSession], DataFrame]


def run_steps(spark: SparkSession, sources: dict[str, DataFrame], steps: list[Step]) -> DataFrame:
    """Registers the sources, then each step as a view over the earlier ones; the last one is returned.

    Views are only names for plans: nothing runs, and the optimizer sees the steps as one query.
    """
    if not steps:
        raise ValueError("no steps")
    for view, df in sources.items():
        df.createOrReplaceTempView(view)
    for step in steps:
        result = spark.sql(step.sql) if isinstance(step.sql, str) else step.sql(spark)
        result.createOrReplaceTempView(step.view)
    return result


def read_steps(path: str) -> list[Step]:
    """Steps from a JSON file: [{"view": ..., "sql": ...}, ...]."""
    with open(path, encoding="utf-8") as source:
        return [Step(entry["view"], entry["sql"]) for entry in json.load(source)]


def order_details(orders: DataFrame, success: str = "SUCCESS") -> DataFrame:
    """Orders with a positive amount, their day and a 0/1 success flag; a NULL status is no success."""
    return orders.filter(F.col("order_amount") > 0).withColumns({
        "order_date": F.to_date("order_time"),
        "is_success": F.when(F.col("order_status") == success, 1).otherwise(0),
    })


def orders_per_day(details: DataFrame) -> DataFrame:
    return details.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("order_cnt"),
        F.sum("order_amount").alias("total_amount"),
        F.sum("is_success").alias("success_order_cnt"),
    )


def daily_order_steps(success: str = "SUCCESS") -> list[Step]:
    """ods_orders -> dwd_orders -> dws_order_day."""
    return [
        Step("dwd_orders", lambda spark: order_details(spark.table("ods_orders"), success)),
        Step("dws_order_day", lambda spark: orders_per_day(spark.table("dwd_orders"))),
    ]
