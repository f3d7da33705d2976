"""From a data dictionary to copy jobs: tables, columns and indexes become one row per table with its keys."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from odsflow.functions.text import scrub, yes_flag
from odsflow.operators.conform import fields_from_metadata
from odsflow.operators.quality import ErrorBudget, KeySpec
from odsflow.plans.jobs import CopyJob, Incremental

BASE_TABLE = "BASE TABLE"
#: What a column listing may hold beside schema and table; what it lacks is NULL.
COLUMN_PARTS = {
    "ordinal_position": "int", "column_name": "string", "data_type": "string", "column_type": "string", "is_nullable": "string",
    "column_default": "string", "column_comment": "string", "data_precision": "int", "data_scale": "int",
}
INDEX_PARTS = {"index_name": "string", "non_unique": "int", "seq_in_index": "int", "column_name": "string"}


def _lowered(listing: DataFrame) -> DataFrame:
    return listing.toDF(*[name.lower() for name in listing.columns])  # databases differ in case


def _part(listing: DataFrame, parts: dict[str, str]) -> Column:
    present = set(listing.columns)
    return F.struct(*[(F.col(n).cast(t) if n in present else F.lit(None).cast(t)).alias(n) for n, t in parts.items()])


def _tagged(listing: DataFrame, kind: str, part: Column, tables: list[tuple[str, str]]) -> DataFrame:
    """Rows (table_schema, table_name) with the part under its kind's name, NULL under the others'."""
    own = [(part if name == kind else F.lit(None).cast(type_)).alias(name) for name, type_ in tables]
    schema = F.col("table_schema") if "table_schema" in listing.columns else F.lit("")
    return listing.select(schema.alias("table_schema"), F.col("table_name"), *own)


def _struct(parts: dict[str, str]) -> str:
    return f"struct<{', '.join(f'{n}: {t}' for n, t in parts.items())}>"


def copy_plan(
    tables: DataFrame, columns: DataFrame, indexes: DataFrame | None = None, schema: str | None = None, kind: str = BASE_TABLE,
    exclude: list[str] = (),
) -> DataFrame:
    """One row per table: table_schema, table_name, comment, columns (in order) and keys (unique indexes, the primary one first).

    Listings have the shape of information_schema `tables`, `columns` and `statistics`. Schema, table and column names are
    told apart as they are and given in lower case. Only tables of the wanted kind (and schema) stay, so views and other schemas drop out with
    their columns and indexes, and tables of one name in two schemas stay two tables. All three listings meet in one aggregate; a
    group has the columns of one table.
    """
    tables, columns = _lowered(tables), _lowered(columns)
    kinds = {"table_type": "string", "table_comment": "string"}
    shapes = [("entry", _struct(kinds)), ("column", _struct(COLUMN_PARTS)), ("key_part", _struct(INDEX_PARTS))]
    listings = [_tagged(tables, "entry", _part(tables, kinds), shapes), _tagged(columns, "column", _part(columns, COLUMN_PARTS), shapes)]
    if indexes is not None:
        indexes = _lowered(indexes)
        listings.append(_tagged(indexes.filter("non_unique = 0"), "key_part", _part(indexes, INDEX_PARTS), shapes))
    rows = reduce(DataFrame.unionByName, listings)
    if schema is not None:
        rows = rows.filter(F.lower("table_schema") == schema.lower())
    if exclude:
        rows = rows.filter(~F.lower("table_name").isin([name.lower() for name in exclude]))
    grouped = rows.groupBy("table_schema", "table_name").agg(
        F.max("entry").alias("entry"), F.array_sort(F.collect_list("column")).alias("columns"), F.collect_list("key_part").alias("parts"),
    ).filter((F.upper("entry.table_type") == kind.upper()) & (F.size("columns") > 0))
    names = F.array_distinct(F.transform("parts", lambda p: p["index_name"]))

    def key(name: Column) -> Column:
        own = F.array_sort(F.transform(
            F.filter("parts", lambda p: p["index_name"] == name), lambda p: F.struct(p["seq_in_index"], F.lower(p["column_name"]).alias("column"))
        ))
        primary = F.upper(name) == "PRIMARY"
        return F.struct((~primary).alias("secondary"), name.alias("name"), F.transform(own, lambda p: p["column"]).alias("columns"))

    return grouped.select(
        F.lower("table_schema").alias("table_schema"), F.lower("table_name").alias("table_name"), scrub(F.col("entry.table_comment")).alias("comment"),
        F.transform("columns", lambda c: c.withField("column_name", F.lower(c["column_name"]))
                    .withField("source_name", c["column_name"]).withField("nullable", yes_flag(c["is_nullable"]))
                    .withField("column_comment", scrub(c["column_comment"]))).alias("columns"),
        F.array_sort(F.transform(names, key)).alias("keys"),
    )


def jobs_from_plan(
    plan: DataFrame,
    reader: Callable[[str, str], Callable],
    writer: Callable[[str, str], Callable[[DataFrame], None]],
    dialect: str = "mysql",
    mode: str = "lossless",
    budget: ErrorBudget = ErrorBudget(),
    mark_columns: dict[str, str] | None = None,
    marks: str | None = None,
) -> list[CopyJob]:
    """One job per row of a copy plan, its keys among the rules of the gate.

    `reader` and `writer` get schema and table. A job is named after its table, with the schema in front if the plan has several. The
    plan has the size of the source's dictionary, so it may come to the driver.
    """
    rows = plan.orderBy("table_schema", "table_name").collect()
    several = len({r["table_schema"] for r in rows}) > 1
    by_mark = {name.lower(): column for name, column in (mark_columns or {}).items()}
    jobs = []
    for row in rows:
        schema, table = row["table_schema"], row["table_name"]
        name = f"{schema}.{table}" if several else table
        listed = [{**c.asDict(), "column_name": c["source_name"], "column_type": c["column_type"] or c["data_type"]} for c in row["columns"]]
        keys = tuple(KeySpec(k["name"], tuple(k["columns"]), not k["secondary"]) for k in row["keys"])
        mark = by_mark.get(name, by_mark.get(table))
        jobs.append(CopyJob(
            name, reader(schema, table), writer(schema, table), fields_from_metadata(listed, dialect, mode), keys=keys, mode=mode,
            budget=budget, incremental=Incremental(mark, marks) if mark else None,
        ))
    return jobs
