"""Type names: source column type to target type name, and to the Spark type.

`target_type` is a column expression for metadata tables read by Spark; `spark_type` is the
plain function behind a copy job's column list.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Source type word -> type name in the target system.
MYSQL_TO_HIVE = {
    "int": "INT", "tinyint": "TINYINT", "smallint": "SMALLINT", "mediumint": "INT", "bigint": "BIGINT",
    "float": "FLOAT", "double": "DOUBLE", "decimal": "DECIMAL",
    "char": "STRING", "varchar": "STRING", "text": "STRING", "mediumtext": "STRING", "longtext": "STRING",
    "date": "DATE", "time": "STRING", "datetime": "TIMESTAMP", "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN", "json": "STRING", "blob": "BINARY",
}
MYSQL_TO_DORIS = {
    "int": "INT", "tinyint": "TINYINT", "smallint": "SMALLINT", "mediumint": "INT", "bigint": "BIGINT",
    "float": "FLOAT", "double": "DOUBLE", "decimal": "DECIMAL",
    "char": "CHAR", "varchar": "VARCHAR", "text": "TEXT", "mediumtext": "TEXT", "longtext": "TEXT",
    "date": "DATE", "time": "TIME", "datetime": "DATETIME", "timestamp": "DATETIME",
    "boolean": "BOOLEAN", "json": "JSONB",
}
MYSQL_TO_POSTGRES = {
    "int": "INTEGER", "tinyint": "SMALLINT", "smallint": "SMALLINT", "mediumint": "INTEGER", "bigint": "BIGINT",
    "float": "REAL", "double": "DOUBLE PRECISION", "decimal": "NUMERIC", "numeric": "NUMERIC",
    "char": "CHAR", "varchar": "VARCHAR",
    "text": "TEXT", "tinytext": "TEXT", "mediumtext": "TEXT", "longtext": "TEXT",
    "blob": "BYTEA", "tinyblob": "BYTEA", "mediumblob": "BYTEA", "longblob": "BYTEA",
    "date": "DATE", "datetime": "TIMESTAMP", "timestamp": "TIMESTAMP", "time": "TIME", "year": "INTEGER",
    "bit": "BIT", "boolean": "BOOLEAN", "enum": "VARCHAR", "set": "VARCHAR", "json": "JSONB",
}
MYSQL_TO_POSTGRES_COPY = {
    "int": "INT4", "tinyint": "INT2", "smallint": "INT2", "mediumint": "INT4", "bigint": "INT8",
    "float": "FLOAT4", "double": "FLOAT8", "decimal": "NUMERIC", "numeric": "NUMERIC",
    "char": "VARCHAR", "varchar": "VARCHAR",
    "text": "TEXT", "tinytext": "TEXT", "mediumtext": "TEXT", "longtext": "TEXT",
    "date": "DATE", "datetime": "TIMESTAMP", "timestamp": "TIMESTAMP", "time": "TIME", "year": "INT2",
    "binary": "BYTEA", "varbinary": "BYTEA",
    "blob": "BYTEA", "tinyblob": "BYTEA", "mediumblob": "BYTEA", "longblob": "BYTEA",
    "enum": "VARCHAR", "set": "VARCHAR", "bit": "BIT",
}
MYSQL_TO_HIVE_COPY = {
    "int": "INT", "tinyint": "TINYINT", "smallint": "SMALLINT", "mediumint": "INT", "bigint": "BIGINT",
    "float": "FLOAT", "double": "DOUBLE", "decimal": "DECIMAL", "numeric": "DECIMAL",
    "char": "CHAR", "varchar": "VARCHAR",
    "text": "STRING", "tinytext": "STRING", "mediumtext": "STRING", "longtext": "STRING",
    "date": "DATE", "datetime": "TIMESTAMP", "timestamp": "TIMESTAMP", "time": "TIME", "year": "INT",
    "binary": "BINARY", "varbinary": "BINARY",
    "blob": "BINARY", "tinyblob": "BINARY", "mediumblob": "BINARY", "longblob": "BINARY",
    "enum": "STRING", "set": "STRING", "bit": "BOOLEAN",
}
ORACLE_TO_ODPS = {
    "varchar2": "STRING", "nvarchar2": "STRING", "char": "STRING", "nchar": "STRING",
    "number": "BIGINT", "int": "BIGINT", "integer": "BIGINT", "binary_integer": "BIGINT",
    "float": "DOUBLE", "double precision": "DOUBLE",
    "date": "DATETIME", "timestamp": "DATETIME",
    "clob": "STRING", "blob": "BINARY", "raw": "BINARY",
}
ORACLE_TO_ODPS_COPY = {
    "varchar2": "string", "nvarchar2": "string", "char": "string", "nchar": "string", "clob": "string",
    "number": "long", "int": "long", "integer": "long", "binary_integer": "long",
    "float": "double", "double precision": "double",
    "date": "date", "timestamp": "date",
    "blob": "bytes", "raw": "bytes",
}
# target -> (type words, name for an unknown word)
TARGETS = {
    "hive": (MYSQL_TO_HIVE, "STRING"),
    "doris": (MYSQL_TO_DORIS, "VARCHAR"),
    "postgres": (MYSQL_TO_POSTGRES, "VARCHAR(255)"),
    "postgres_copy": (MYSQL_TO_POSTGRES_COPY, "VARCHAR"),
    "hive_copy": (MYSQL_TO_HIVE_COPY, "STRING"),
    "odps": (ORACLE_TO_ODPS, "STRING"),
    "odps_copy": (ORACLE_TO_ODPS_COPY, "string"),
}
# Source type word -> Spark type. Decimals, bits and Oracle numbers follow a rule below.
MYSQL_TO_SPARK = {
    "tinyint": "tinyint", "smallint": "smallint", "mediumint": "int", "int": "int", "integer": "int",
    "bigint": "bigint", "float": "float", "double": "double", "year": "int", "boolean": "boolean",
    "char": "string", "varchar": "string",
    "text": "string", "tinytext": "string", "mediumtext": "string", "longtext": "string",
    "date": "date", "datetime": "timestamp", "timestamp": "timestamp", "time": "string",
    "binary": "binary", "varbinary": "binary",
    "blob": "binary", "tinyblob": "binary", "mediumblob": "binary", "longblob": "binary",
    "enum": "string", "set": "string", "json": "string",
}
MYSQL_UNSIGNED_TO_SPARK = {
    "tinyint": "smallint", "smallint": "int", "mediumint": "int", "int": "bigint", "integer": "bigint",
    "bigint": "decimal(20,0)",
}
ORACLE_TO_SPARK = {
    "varchar2": "string", "nvarchar2": "string", "char": "string", "nchar": "string", "clob": "string",
    "int": "bigint", "integer": "bigint", "binary_integer": "bigint",
    "float": "double", "double precision": "double",
    "date": "timestamp", "timestamp": "timestamp",
    "blob": "binary", "raw": "binary",
}
MAX_DIGITS = 38


def base_word(type_text: Column) -> Column:
    """The type's own word: `decimal(10,2)` -> `decimal`, `INT(10) unsigned` -> `int`."""
    return F.lower(F.trim(F.regexp_extract(type_text, r"^\s*([A-Za-z][A-Za-z0-9_]*( +precision| +PRECISION)?)", 1)))


def type_digits(type_text: Column) -> Column:
    """What stands between the brackets when it is one or two numbers, blanks removed; else empty."""
    return F.regexp_replace(F.regexp_extract(type_text, r"\((\s*\d+\s*(?:,\s*\d+\s*)?)\)", 1), r"\s", "")


def target_type(type_text: Column, target: str) -> Column:
    """Type name in the target system, with length or precision where the target takes one."""
    words, unknown = TARGETS[target]
    pairs = [F.lit(part) for pair in words.items() for part in pair]
    word = base_word(type_text)
    name = F.coalesce(F.element_at(F.create_map(*pairs), word), F.lit(unknown))
    digits = type_digits(type_text)
    bracketed = F.concat(name, F.lit("("), digits, F.lit(")"))
    if target == "hive":
        return F.when((word == "decimal") & digits.contains(","), bracketed).otherwise(name)
    if target == "postgres":
        return (
            F.when(word.isin("char", "varchar"),
                   F.concat(name, F.lit("("), F.when(digits == "", "255").otherwise(digits), F.lit(")")))
            .when(word.isin("decimal", "numeric") & digits.contains(","), bracketed)
            .when(word == "enum", F.lit("VARCHAR(255)"))
            .otherwise(name)
        )
    if target in ("odps", "odps_copy"):
        precision = F.split_part(digits, F.lit(","), F.lit(1)).try_cast("int")
        scale = F.split_part(digits, F.lit(","), F.lit(2)).try_cast("int")
        fraction, whole = ("DOUBLE", "INT") if target == "odps" else ("double", "long")
        return (
            F.when((word == "number") & (scale > 0), F.lit(fraction))
            .when((word == "number") & (precision <= 10), F.lit(whole))
            .otherwise(name)
        )
    return name


def _decimal(precision: int, scale: int) -> str:
    return f"decimal({precision},{scale})" if precision <= MAX_DIGITS else "string"


def _mysql_spark_type(text: str, mode: str) -> str:
    match = re.match(r"\s*([a-z]+)\s*(?:\(([^)]*)\))?(.*)", text.lower())
    word, inside, rest = match.groups() if match else ("", None, "")
    numbers = [int(n) for n in re.findall(r"\d+", inside or "")]
    if word in ("decimal", "numeric"):
        return _decimal(numbers[0] if numbers else 10, numbers[1] if len(numbers) > 1 else 0)
    if word == "bit":
        return "boolean" if not numbers or numbers[0] == 1 else "binary"
    if mode == "lossless" and "unsigned" in rest and word in MYSQL_UNSIGNED_TO_SPARK:
        return MYSQL_UNSIGNED_TO_SPARK[word]
    return MYSQL_TO_SPARK.get(word, "string")


def _oracle_spark_type(text: str, mode: str, precision: int | None, scale: int | None) -> str:
    word = text.split("(")[0].strip().lower()
    if word != "number":
        return ORACLE_TO_SPARK.get(word, "string")
    if precision is None:
        numbers = [int(n) for n in re.findall(r"-?\d+", text)]
        precision = numbers[0] if numbers else None
        scale = numbers[1] if len(numbers) > 1 else scale
    if mode == "reference":
        if scale is not None and scale > 0:
            return "double"
        return "int" if precision is not None and precision <= 10 else "bigint"
    if precision is None:
        return "decimal(38,10)"
    if scale is not None and scale > 0:
        return _decimal(max(precision, scale), scale)
    digits = precision - (scale or 0)
    if digits <= 9:
        return "int"
    return "bigint" if digits <= 18 else _decimal(digits, 0)


def spark_type(
    type_text: str,
    dialect: str = "mysql",
    mode: str = "lossless",
    precision: int | None = None,
    scale: int | None = None,
) -> str:
    """Spark type (DDL text) of a source column; unknown types land as string.

    `reference` keeps the narrow historical choices (Oracle fractions as double, unsigned
    ignored); `lossless` widens so that no source value is changed.
    """
    if mode not in ("lossless", "reference"):
        raise ValueError(f"unknown mode {mode!r}")
    if dialect == "mysql":
        return _mysql_spark_type(type_text, mode)
    if dialect == "oracle":
        return _oracle_spark_type(type_text, mode, precision, scale)
    raise ValueError(f"unknown dialect {dialect!r}")
