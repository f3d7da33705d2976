"""Metadata tables as data: column inventories, exclusion lists, ordered key lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from odsflow.functions.text import scrub, yes_flag


def tidy_columns(columns: DataFrame, tables: DataFrame, schema: str, kind: str = "BASE TABLE") -> DataFrame:
    """Columns of one schema's tables in order: lower-case names, 0/1 nullability, scrubbed comments.

    Inputs have the shape of information_schema `columns` and `tables`; views drop out.
    """
    wanted = tables.filter((F.col("table_schema") == schema) & (F.col("table_type") == kind)).select(
        "table_schema", "table_name"
    )
    return (
        columns.filter(F.col("table_schema") == schema)
        .join(wanted, ["table_schema", "table_name"], "left_semi")
        .select(
            F.lower("table_name").alias("table_name"),
            F.col("ordinal_position").cast("int").alias("ordinal_position"),
            F.lower("column_name").alias("column_name"),
            F.col("data_type"),
            F.col("column_type" if "column_type" in columns.columns else "data_type").alias("column_type"),
            yes_flag(F.col("is_nullable")).alias("is_nullable"),
            scrub(F.col("column_comment")).alias("column_comment"),
            F.col("column_default"),
        )
        .orderBy("table_name", "ordinal_position")
    )


def catalog_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Columns of the session catalog's tables; one row per column, views left out."""
    rows = [
        (table.database, table.name, position, column.name, column.dataType, column.nullable, column.description)
        for table in spark.catalog.listTables(database)
        if not table.isTemporary and table.tableType != "VIEW"
        for position, column in enumerate(
            spark.catalog.listColumns(f"`{table.database}`.`{table.name}`" if table.database else table.name), 1
        )
    ]
    return spark.createDataFrame(
        rows,
        "table_schema string, table_name string, ordinal_position int, column_name string, "
        "data_type string, nullable boolean, column_comment string",
    )


def column_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: place, type, row and NULL counts, and whether NULLs occur.

    Each table costs one pass that shuffles a single row per task.
    """
    def of_table(name: str, df: DataFrame) -> DataFrame:
        counts = df.agg(
            F.count(F.lit(1)).alias("all_rows"),
            *[F.count(F.col(f"`{c}`")).alias(f"filled_{i}") for i, c in enumerate(df.columns)],
        )
        entries = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(i + 1).alias("ordinal_position"),
                F.lit(f.name.lower()).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("all_rows").alias("row_cnt"),
                (F.col("all_rows") - F.col(f"filled_{i}")).alias("null_cnt"),
                F.when(F.col("all_rows") > F.col(f"filled_{i}"), 1).otherwise(0).alias("is_nullable"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
        return counts.select(F.inline(F.array(*entries)))

    return reduce(DataFrame.unionByName, [of_table(name, df) for name, df in tables.items()])


def exclude_names(df: DataFrame, column: str, names: list[str] | DataFrame) -> DataFrame:
    """Rows whose name is not in the list, compared in upper case; NULL names drop out as in NOT IN.

    A DataFrame of names (first column) becomes an anti join, which Spark broadcasts only when the
    names are below its size limit.
    """
    upper = F.upper(F.col(column))
    if isinstance(names, DataFrame):
        listed = names.select(F.upper(F.col(names.columns[0])).alias("_name"))
        return df.filter(F.col(column).isNotNull()).join(listed, upper == F.col("_name"), "left_anti")
    return df.filter(~upper.isin([name.upper() for name in names])) if names else df


def ordered_columns(df: DataFrame, group: list[str], position: str, name: str) -> DataFrame:
    """Per group (a table, a key, an index) the column names in order of position.

    For metadata rows: a group never exceeds the column count of one table.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(position), F.col(name).alias("name"))))
    return df.groupBy(*group).agg(F.transform(pairs, lambda p: p["name"]).alias("column_names"))
