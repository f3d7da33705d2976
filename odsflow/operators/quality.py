"""Row rules, key rules and the error budget.

Spark tables do not enforce NOT NULL, keys, lengths or domains, so a load checks them on the
data before it writes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from odsflow.operators.metadata import ordered_columns

REASONS = "_reasons"


@dataclass(frozen=True)
class Rule:
    """A named condition that is true for a bad row."""

    name: str
    broken: Column


@dataclass(frozen=True)
class ErrorBudget:
    """Bad rows a load may hold: a count, a share of all rows, or both; None means no limit."""

    records: int | None = 0
    share: float | None = 0.02


class BudgetExceeded(Exception):
    def __init__(self, total: int, bad: int, budget: ErrorBudget):
        super().__init__(f"{bad} of {total} rows are bad; allowed: {budget}")
        self.total, self.bad = total, bad


def not_null(column: str) -> Rule:
    return Rule(f"{column}:null", F.col(column).isNull())


def max_length(column: str, length: int) -> Rule:
    return Rule(f"{column}:length", F.char_length(column) > length)


def in_domain(column: str, domain: list[str]) -> Rule:
    """A value outside the list is bad; NULL is left to `not_null`."""
    return Rule(f"{column}:domain", ~F.col(column).isin(list(domain)))


def reasons(rules: list[Rule]) -> Column:
    """Names of the broken rules of a row, in rule order.

    A concat of short arrays keeps whole-stage code generation; dropping NULLs from one array would
    leave it and take twice the time.
    """
    none = F.array().cast("array<string>")
    if not rules:
        return none
    return F.concat(*[F.when(rule.broken, F.array(F.lit(rule.name))).otherwise(none) for rule in rules])


def with_reasons(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds the broken rules to those a row already carries."""
    found = reasons(rules)
    if REASONS in df.columns:
        found = F.concat(F.col(REASONS), found)
    return df.withColumn(REASONS, found)


def is_bad() -> Column:
    return F.size(REASONS) > 0


def split_good_bad(df: DataFrame, rules: list[Rule] = ()) -> tuple[DataFrame, DataFrame]:
    """Good rows without, bad rows with their reasons."""
    marked = with_reasons(df, list(rules)) if rules or REASONS not in df.columns else df
    return marked.filter(~is_bad()).drop(REASONS), marked.filter(is_bad())


def key_violations(df: DataFrame, keys: list[str], primary: bool = True) -> DataFrame:
    """Keys that occur more than once; for a primary key also keys with a NULL part.

    In a unique index NULL keys do not collide, so they are left out. Counting starts on the
    map side: a key that holds a third of the rows reaches the shuffle as one row per task.
    """
    has_null = reduce(or_, [F.col(k).isNull() for k in keys])
    if not primary:
        df = df.filter(~has_null)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_cnt"))
    return counted.filter((F.col("row_cnt") > 1) | has_null) if primary else counted.filter("row_cnt > 1")


@dataclass(frozen=True)
class KeySpec:
    """A declared key: its name, its columns in order, and whether it is the primary key."""

    name: str
    columns: tuple[str, ...]
    primary: bool = False


def key_specs(indexes: DataFrame, table: str) -> list[KeySpec]:
    """The unique keys of a table out of an index listing (table_name, index_name, non_unique,
    seq_in_index, column_name); one row per index reaches the driver."""
    listing = indexes.toDF(*[name.lower() for name in indexes.columns])  # databases differ in case
    unique = listing.filter((F.lower("table_name") == table.lower()) & (F.col("non_unique") == 0))
    rows = ordered_columns(unique, ["index_name"], "seq_in_index", "column_name").orderBy("index_name").collect()
    return [
        KeySpec(row["index_name"], tuple(c.lower() for c in row["column_names"]), row["index_name"].upper() == "PRIMARY")
        for row in rows
    ]


def with_key_reasons(df: DataFrame, specs: Sequence[KeySpec]) -> DataFrame:
    """Adds `key:<name>` to the reasons of rows whose key value is broken (see `key_violations`).

    Every row of a repeated key is named. The broken keys are joined back on equality; NULL parts of
    a primary key count as equal.
    """
    for spec in specs:
        broken = key_violations(df.select(*spec.columns), list(spec.columns), spec.primary)
        broken = broken.select(F.struct(*spec.columns).alias("_broken"))
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_broken.{c}")) for c in spec.columns])
        found = F.when(F.col("_broken").isNotNull(), F.array(F.lit(f"key:{spec.name}"))).otherwise(F.array().cast("array<string>"))
        df = df.join(broken, same, "left").withColumn(REASONS, F.concat(F.col(REASONS), found)).drop("_broken")
    return df


def key_report(df: DataFrame, specs: list[KeySpec]) -> DataFrame:
    """One row per key: how many key values are broken and how many rows they hold."""
    def of_key(spec: KeySpec) -> DataFrame:
        broken = key_violations(df.select(*spec.columns), list(spec.columns), spec.primary)
        return broken.agg(
            F.count(F.lit(1)).alias("broken_keys"), F.coalesce(F.sum("row_cnt"), F.lit(0)).alias("rows_hit")
        ).select(
            F.lit(spec.name).alias("key_name"), F.lit(",".join(spec.columns)).alias("key_columns"),
            "broken_keys", "rows_hit",
        )

    return reduce(DataFrame.unionByName, [of_key(spec) for spec in specs])


def fits_budget(total, bad, budget: ErrorBudget):
    """Whether the counts (numbers or columns) stay within both limits."""
    fits = []
    if budget.records is not None:
        fits.append(bad <= budget.records)
    if budget.share is not None:
        fits.append(bad <= total * budget.share)
    return reduce(and_, fits) if fits else None


def budget_report(df: DataFrame, budget: ErrorBudget) -> DataFrame:
    """One row: total_rows, bad_rows, within_budget. Reads only the columns the rules need."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_bad()).alias("bad_rows"),
    )
    fits = fits_budget(F.col("total_rows"), F.col("bad_rows"), budget)
    return counted.withColumn("within_budget", F.lit(True) if fits is None else fits)


def check_counts(total: int, bad: int, budget: ErrorBudget) -> tuple[int, int]:
    if fits_budget(total, bad, budget) is False:
        raise BudgetExceeded(total, bad, budget)
    return total, bad


def enforce_budget(df: DataFrame, budget: ErrorBudget) -> tuple[int, int]:
    """(total, bad), or BudgetExceeded; to be called before anything is written."""
    row = budget_report(df, budget).first()
    return check_counts(row["total_rows"], row["bad_rows"], budget)
