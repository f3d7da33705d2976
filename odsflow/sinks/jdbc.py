"""Database writes, left to Spark's own JDBC sink.

The sink commits per task, so a lost executor can repeat a task after its commit: a plain append is
at-least-once. `jdbc_upsert` (a staging table of its own run, then one MERGE of the latest row per key,
guarded by the sequence) is not harmed by repeats. Rows are dealt to the connections by a shuffle, so
the work before the write keeps all its tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

BATCH_SIZE = 5000
RELOAD_BATCH_SIZE = 1024
CONNECTIONS = 8


def jdbc_append(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    batch_size: int = BATCH_SIZE,
    connections: int = CONNECTIONS,
) -> None:
    """Appends in batches; `connections` is the number of tasks that write."""
    options = {"batchsize": str(batch_size), "numPartitions": str(connections), **(properties or {})}
    df.repartition(connections).write.mode("append").options(**options).jdbc(url, table)


def jdbc_truncate_load(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    batch_size: int = RELOAD_BATCH_SIZE,
    connections: int = CONNECTIONS,
) -> None:
    """Empties the table, keeping its definition, and loads it. Gate the rows before calling this."""
    options = {
        "batchsize": str(batch_size), "numPartitions": str(connections), "truncate": "true", **(properties or {})
    }
    df.repartition(connections).write.mode("overwrite").options(**options).jdbc(url, table)


def jdbc_execute(spark: SparkSession, url: str, statement: str, properties: dict[str, str] | None = None) -> None:
    """One statement in the target database over a driver connection; moves no rows."""
    settings = spark._jvm.java.util.Properties()
    for key, value in (properties or {}).items():
        if key == "driver":
            spark._jvm.java.lang.Class.forName(value)
        settings.setProperty(key, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.createStatement().execute(statement)
    finally:
        connection.close()


def merge_statement(
    target: str, staging: str, columns: list[str], keys: list[str], order: list[str]
) -> str:
    """Standard MERGE of a staging table; a row changes only when the staged sequence is later.

    Of several staged rows of a key only the latest counts, so rows staged twice do no harm.

    Deleted rows stay with op = 'D', so a late older update cannot bring them back; read the target
    through a view without them.
    """
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    later = " OR ".join(
        "(" + " AND ".join([f"s.{p} = t.{p}" for p in order[:i]] + [f"s.{c} > t.{c}"]) + ")"
        for i, c in enumerate(order)
    )
    sets = ", ".join(f"{c} = s.{c}" for c in columns if c not in keys)
    names, values = ", ".join(columns), ", ".join(f"s.{c}" for c in columns)
    latest = ", ".join(f"{c} DESC" for c in order)
    once = (
        f"(SELECT {names} FROM (SELECT {names}, ROW_NUMBER() OVER (PARTITION BY {', '.join(keys)} ORDER BY {latest}) AS nth "
        f"FROM {staging}) d WHERE d.nth = 1)"
    )
    return (
        f"MERGE INTO {target} t USING {once} s ON {on} "
        f"WHEN MATCHED AND ({later}) THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def jdbc_upsert(
    latest: DataFrame,
    url: str,
    target: str,
    keys: list[str],
    order: list[str],
    properties: dict[str, str] | None = None,
    staging: str | None = None,
) -> None:
    """Upserts one row per key: executors fill a staging table, the database merges it.

    Without a name the staging table belongs to this run alone and is dropped after it.
    """
    own = staging or f"{target}_staging_{uuid.uuid4().hex[:12]}"
    try:
        jdbc_truncate_load(latest, url, own, properties, batch_size=BATCH_SIZE)
        jdbc_execute(latest.sparkSession, url, merge_statement(target, own, latest.columns, keys, order), properties)
    finally:
        if not staging:
            jdbc_execute(latest.sparkSession, url, f"DROP TABLE {own}", properties)
