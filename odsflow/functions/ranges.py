"""Key ranges that cut a table into slices for a parallel read."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F


def even_edges(lower: int, upper: int, slices: int) -> list[int]:
    """Inner edges of `slices` equal ranges over [lower, upper]; bounds set the stride only."""
    width = upper - lower + 1
    edges = [lower + width * i // slices for i in range(1, slices)]
    return sorted({edge for edge in edges if edge > lower})


def quantiles(df: DataFrame, column: str, slices: int, accuracy: int = 10000) -> list:
    """The values that cut a column into `slices` equally full parts; a hot value comes up repeatedly.

    Whole and decimal numbers, dates and timestamps; for texts and several columns see `sorted_cuts`.
    """
    shares = [i / slices for i in range(1, slices)]
    if not shares:
        return []
    return df.agg(F.percentile_approx(column, shares, accuracy).alias("cuts")).first()["cuts"] or []


def quantile_edges(df: DataFrame, column: str, slices: int, accuracy: int = 10000) -> list:
    """Inner edges at the quantiles of a column, so that skewed keys still give even slices."""
    return sorted(set(quantiles(df, column, slices, accuracy)))


def sorted_cuts(df: DataFrame, columns: Sequence[str], slices: int, width: int = 1000) -> list[tuple]:
    """Tuples that cut the rows, in the order of several columns of any type, into about equally full slices.

    The rows are sorted by range into `slices * width` runs or fewer, of which each leaves its first tuple and its
    size; those rows alone come to the driver. A tuple that would come up again is left out, so a hot tuple is one slice:
    add a column that cuts it. Rows with a NULL part lie below every cut (see `tuple_predicates`) and give none.
    """
    if slices < 2:
        return []
    whole = df.select(*columns).dropna()
    runs = min(slices * 8, width)
    keyed = whole.repartitionByRange(runs, *columns).withColumn("_run", F.spark_partition_id())
    first = F.min(F.struct(*columns)).alias("first")
    found = keyed.groupBy("_run").agg(first, F.count(F.lit(1)).alias("n")).orderBy("first").collect()
    total, passed, cuts = sum(r["n"] for r in found), 0, []
    for row in found:
        if passed and len(cuts) < slices - 1 and passed * slices >= total * (len(cuts) + 1):
            cut = tuple(row["first"][c] for c in columns)
            if not cuts or cuts[-1] != cut:
                cuts.append(cut)
        passed += row["n"]
    return cuts


def literal(value) -> str:
    """A value as an SQL literal of its own type: numbers plain, dates and timestamps named, texts in quotes that are doubled inside.

    A backslash has no meaning in standard SQL but is an escape in Spark and MySQL, so a text with one is an error rather
    than a guess.
    """
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return format(value, "f") if isinstance(value, Decimal) else str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        if "\\" in value:
            raise ValueError(f"a key with a backslash cannot be written alike for all databases: {value!r}")
        return "'" + value.replace("'", "''") + "'"
    raise TypeError(f"no literal for a key of {type(value).__name__}")


def range_predicates(column: str, edges: list) -> list[str]:
    """SQL predicates, one per slice; together they take every row exactly once.

    The first slice also takes NULLs and all below the first edge, the last all above. Edges may be numbers, dates, timestamps or texts.
    """
    if not edges:
        return ["1 = 1"]
    values = [literal(edge) for edge in edges]
    first = f"{column} < {values[0]} OR {column} IS NULL"
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(values, values[1:])]
    return [first, *middle, f"{column} >= {values[-1]}"]


def _below(columns: Sequence[str], cut: Sequence) -> str:
    """Rows before a tuple in the order of the columns, NULL lowest; spelt out, since not every database compares rows."""
    column, value = columns[0], literal(cut[0])
    parts = [f"{column} IS NULL", f"{column} < {value}"]
    if len(columns) > 1:
        parts.append(f"({column} = {value} AND ({_below(columns[1:], cut[1:])}))")
    return " OR ".join(parts)


def _from(columns: Sequence[str], cut: Sequence) -> str:
    """Rows at or behind a tuple."""
    column, value = columns[0], literal(cut[0])
    if len(columns) == 1:
        return f"{column} >= {value}"
    return f"{column} > {value} OR ({column} = {value} AND ({_from(columns[1:], cut[1:])}))"


def tuple_predicates(columns: Sequence[str], cuts: list[tuple]) -> list[str]:
    """Predicates that cut a table by several columns in their order; every row falls under exactly one.

    `cuts` rise. A NULL counts as lower than every value of its column. The leading column is also bounded by itself, so that an
    index on it serves.
    """
    if not cuts:
        return ["1 = 1"]
    lead = columns[0]
    first = f"({_below(columns, cuts[0])}) AND ({lead} <= {literal(cuts[0][0])} OR {lead} IS NULL)"
    middle = [
        f"({_from(columns, a)}) AND ({_below(columns, b)}) AND {lead} >= {literal(a[0])} AND {lead} <= {literal(b[0])}"
        for a, b in zip(cuts, cuts[1:])
    ]
    return [first, *middle, f"({_from(columns, cuts[-1])}) AND {lead} >= {literal(cuts[-1][0])}"]


def _salted(salt: str, times: int, part: int) -> str:
    """One of `times` parts by the size of a whole number's remainder; NULLs go to part 0. ABS never meets a negative number, of which the least would overflow."""
    own = f"CASE WHEN {salt} < 0 THEN -MOD({salt}, {times}) ELSE MOD(ABS({salt}), {times}) END = {part}"
    return f"({own} OR {salt} IS NULL)" if part == 0 else own


def skewed_predicates(column: str, cuts: list, salt: str) -> list[str]:
    """Predicates from `quantiles` that also cut a hot value: each row still falls under exactly one.

    A value found several times fills that many slices by itself; its rows are spread by the whole
    number column `salt` (a key of the table), of which NULLs fall under the first part.
    """
    counts = Counter(cuts)
    hot = {value: times for value, times in sorted(counts.items()) if times > 1}
    if not hot:
        return range_predicates(column, sorted(counts))
    listed = ", ".join(literal(value) for value in hot)
    others = f"({column} IS NULL OR {column} NOT IN ({listed}))"
    ranges = [f"({predicate}) AND {others}" for predicate in range_predicates(column, sorted(counts))]
    spread = [f"{column} = {literal(value)} AND {_salted(salt, times, part)}"
              for value, times in hot.items() for part in range(times)]
    return ranges + spread


def slices_of(predicates: list[str]) -> Column:
    """The numbers of the slices a row falls under, in one pass; exactly one if the predicates are right."""
    found = [F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)]
    return F.array_compact(F.array(*found))
