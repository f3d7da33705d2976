"""Give a table its declared columns: types, defaults, comments, rules; one projection."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from odsflow.functions.types import spark_type
from odsflow.operators.quality import REASONS, Rule, reasons


@dataclass(frozen=True)
class Field:
    """One target column. `source` is the input column, when its name differs."""

    name: str
    type: str
    source: str | None = None
    required: bool = False
    default: str | None = None
    comment: str = ""
    length: int | None = None
    domain: tuple[str, ...] = field(default=())


def _whole(number) -> int | None:
    """Databases return precision and scale as decimals."""
    return None if number is None else int(number)


def declared_length(type_text: str) -> int | None:
    """n of char(n), varchar(n) and varchar2(n)."""
    found = re.match(r"(?i)\s*n?(?:var)?char2?\s*\(\s*(\d+)", type_text or "")
    return int(found[1]) if found else None


def declared_domain(type_text: str) -> tuple[str, ...]:
    """The values of enum('a','b')."""
    found = re.match(r"(?is)\s*enum\s*\((.*)\)", type_text or "")
    return tuple(v.replace("''", "'") for v in re.findall(r"'((?:[^']|'')*)'", found[1])) if found else ()


def fields_from_metadata(rows: list[dict], dialect: str = "mysql", mode: str = "lossless") -> list[Field]:
    """Target columns from metadata rows (column_name, column_type, is_nullable, default, comment).

    The rows describe one table, so their number is that of its columns. Lengths and domains come from
    the type text.
    """
    return [
        Field(
            name=row["column_name"].lower(),
            source=row["column_name"],
            type=spark_type(
                row["column_type"], dialect, mode, _whole(row.get("data_precision")), _whole(row.get("data_scale"))
            ),
            required=str(row.get("is_nullable") or "YES").upper() not in ("YES", "Y"),
            default=row.get("column_default"),
            comment=row.get("column_comment") or "",
            length=declared_length(row["column_type"]),
            domain=declared_domain(row["column_type"]),
        )
        for row in rows
    ]


def default_value(text: str | None, type_name: str) -> Column:
    """The column DEFAULT as a typed literal; CURRENT_TIMESTAMP, NOW() and NULL keep their meaning."""
    if text is None or text.upper() == "NULL":
        return F.lit(None).cast(type_name)
    if text.upper() in ("CURRENT_TIMESTAMP", "NOW()"):
        return F.current_timestamp().cast(type_name)
    return F.lit(text).cast(type_name)


def fill_absent(df: DataFrame, fields: list[Field]) -> DataFrame:
    """Adds columns the load lacks with their default; NULLs in a present column stay NULL."""
    present = {name.lower() for name in df.columns}
    absent = {f.name: default_value(f.default, f.type) for f in fields if (f.source or f.name).lower() not in present}
    return df.withColumns(absent) if absent else df


def _changed(source: Column, value: Column, source_type: T.DataType, target_type: T.DataType) -> Column | None:
    """True where a value was cast but not kept, e.g. 12.345 to two places or a timestamp to its day."""
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    floating = (T.FloatType, T.DoubleType)
    if isinstance(source_type, integral) and isinstance(target_type, floating):
        return F.coalesce(value.try_cast("bigint") != source, value.isNotNull())  # back out of range: not kept
    if isinstance(source_type, T.DoubleType) and isinstance(target_type, T.FloatType):
        return source != value.cast(source_type)
    if isinstance(source_type, T.DecimalType) and isinstance(target_type, floating):
        return F.coalesce(value.try_cast(source_type) != source, value.isNotNull())
    if isinstance(source_type, (T.TimestampType, T.TimestampNTZType)) and isinstance(target_type, T.DateType):
        return source != value.cast(source_type)
    if isinstance(source_type, T.StringType) and isinstance(target_type, T.DateType):
        return source.try_cast("timestamp_ntz") != value.cast("timestamp_ntz")
    if isinstance(source_type, T.StringType) and isinstance(target_type, floating):
        return source.rlike(r"^\s*[+-]?\d+\s*$") & F.coalesce(
            source.try_cast("bigint") != value.try_cast("bigint"), source.try_cast("bigint").isNotNull()
        )
    if isinstance(source_type, T.StringType) and isinstance(target_type, T.DecimalType):
        whole = target_type.precision - target_type.scale
        if whole + target_type.scale == 38:
            return source.rlike(rf"\.\d{{{target_type.scale}}}\d*[1-9]")
        return source.try_cast(T.DecimalType(38, 38 - whole)) != value
    if isinstance(source_type, (T.FloatType, T.DoubleType)) and isinstance(target_type, (T.DecimalType, *integral)):
        return source != value.cast(source_type)
    if isinstance(source_type, T.DecimalType) and isinstance(target_type, (T.DecimalType, *integral)):
        return source != value
    return None


def conform(df: DataFrame, fields: list[Field], mode: str = "lossless") -> DataFrame:
    """The declared columns in order, plus the broken rules of each row.

    A NULL out of a non-NULL input is a reject. `lossless` also rejects a number that the cast
    rounded and a time of day that a date cannot hold; `reference` lets them pass.
    """
    if mode not in ("lossless", "reference"):
        raise ValueError(f"unknown mode {mode!r}")
    filled = fill_absent(df, fields)
    types = {f.name.lower(): f.dataType for f in filled.schema.fields}
    columns, rules = [], []
    for item in fields:
        source = item.source if item.source and item.source.lower() in types else item.name
        before, target = F.col(source), T.DataType.fromDDL(item.type)
        value = before.try_cast(target)
        columns.append(value.alias(item.name, metadata={"comment": item.comment} if item.comment else {}))
        rules.append(Rule(f"{item.name}:type", before.isNotNull() & value.isNull()))
        changed = _changed(before, value, types[source.lower()], target) if mode == "lossless" else None
        if changed is not None:
            rules.append(Rule(f"{item.name}:changed", changed))
        if item.required:
            rules.append(Rule(f"{item.name}:null", before.isNull()))
        if item.length is not None:
            rules.append(Rule(f"{item.name}:length", F.char_length(value) > item.length))
        if item.domain:
            rules.append(Rule(f"{item.name}:domain", ~value.isin(list(item.domain))))
    return filled.select(*columns, reasons(rules).alias(REASONS))
