"""Database reads, left to Spark's own JDBC source.

Credentials come in through `properties`; nothing is stored here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from odsflow.functions.ranges import quantiles, skewed_predicates

FETCH_SIZE = "1024"
#: Slices of a small table, and rows per slice of a large one. How many are read at once is up to the executors' cores.
SLICES = 8
ROWS_PER_SLICE = 2_000_000

# Metadata tables, to be read with `jdbc_query`; the column listings fit `plans.jobs.jobs_from_columns`.
# They list the database of the connection, not the whole server.
MYSQL_TABLES = (
    "SELECT table_schema, table_name, table_type, table_comment FROM information_schema.tables "
    "WHERE table_schema = DATABASE()"
)
MYSQL_COLUMNS = (
    "SELECT table_schema, table_name, ordinal_position, column_name, data_type, column_type, "
    "is_nullable, column_default, column_comment FROM information_schema.columns WHERE table_schema = DATABASE()"
)
MYSQL_INDEXES = (
    "SELECT table_schema, table_name, index_name, non_unique, seq_in_index, column_name "
    "FROM information_schema.statistics WHERE table_schema = DATABASE()"
)
ORACLE_COLUMNS = (
    "SELECT c.table_name, c.column_id AS ordinal_position, c.column_name, c.data_type AS column_type, "
    "c.data_length, c.data_precision, c.data_scale, c.nullable AS is_nullable, m.comments AS column_comment "
    "FROM user_tab_columns c LEFT JOIN user_col_comments m "
    "ON m.table_name = c.table_name AND m.column_name = c.column_name"
)
ORACLE_TABLES = (
    "SELECT t.table_name, m.comments FROM user_tables t LEFT JOIN user_tab_comments m "
    "ON m.table_name = t.table_name"
)

HIVE_COLUMNS = (  # the metastore's own database
    "SELECT d.NAME AS table_schema, t.TBL_NAME AS table_name, t.TBL_TYPE AS table_type, "
    "c.INTEGER_IDX + 1 AS ordinal_position, c.COLUMN_NAME AS column_name, c.TYPE_NAME AS data_type, "
    "c.COMMENT AS column_comment FROM DBS d JOIN TBLS t ON t.DB_ID = d.DB_ID JOIN SDS s ON s.SD_ID = t.SD_ID "
    "JOIN COLUMNS_V2 c ON c.CD_ID = s.CD_ID"
)


def _properties(properties: dict[str, str] | None) -> dict[str, str]:
    return {"fetchsize": FETCH_SIZE, **(properties or {})}


def jdbc_query(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None) -> DataFrame:
    """The rows of one statement through one connection; for metadata and small tables."""
    return spark.read.format("jdbc").options(url=url, query=query, **_properties(properties)).load()


def column_bounds(
    spark: SparkSession, url: str, table: str, column: str, properties: dict[str, str] | None = None
) -> tuple:
    """Smallest and largest key and the number of rows, computed by the database."""
    row = jdbc_query(
        spark, url, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT(*) AS n FROM {table}", properties
    ).first()
    return row[0], row[1], row[2]


def slices_for(rows: int) -> int:
    """Slices for a table of that many rows."""
    return max(SLICES, -(-int(rows) // ROWS_PER_SLICE))


def jdbc_partitioned_read(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int | None = None,
    upper: int | None = None,
    slices: int | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Parallel read by key range. Bounds set the stride only: no row is filtered.

    Without bounds the table's own ones are asked for first, so that fixed guesses do not leave
    most rows to one slice; without a number of slices it follows the rows (`slices_for`). Strides are even, so
    uneven keys need `jdbc_column_read` with a salt.
    """
    if lower is None or upper is None or slices is None:
        low, high, rows = column_bounds(spark, url, table, column, properties)
        slices = slices or slices_for(rows or 0)
        lower = low if lower is None else lower
        upper = high if upper is None else upper
    if lower is None or upper is None or lower >= upper:
        return spark.read.jdbc(url, table, properties=_properties(properties))
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=slices,
        properties=_properties(properties),
    )


def jdbc_sliced_read(
    spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict[str, str] | None = None
) -> DataFrame:
    """Parallel read with one predicate per task (see `functions.ranges`), for uneven keys."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=_properties(properties))


def jdbc_column_read(
    spark: SparkSession,
    url: str,
    table: str,
    columns: list[str],
    split_key: str | None = None,
    slices: int | None = None,
    properties: dict[str, str] | None = None,
    salt: str | None = None,
) -> DataFrame:
    """The listed columns of a table, in parallel when a split key is given.

    With `salt` (a whole number column) the slices are cut at the key's quantiles, and
    a value that fills several slices alone is spread by the salt: first the key column is read for
    that, in even strides, then the rows, a predicate per slice.
    """
    if split_key and salt:
        keys = jdbc_partitioned_read(spark, url, table, split_key, slices=slices, properties=properties).select(split_key)
        wanted = slices or keys.rdd.getNumPartitions()
        predicates = skewed_predicates(split_key, quantiles(keys, split_key, wanted), salt)
        df = jdbc_sliced_read(spark, url, table, predicates, properties)
    elif split_key:
        df = jdbc_partitioned_read(spark, url, table, split_key, slices=slices, properties=properties)
    else:
        df = spark.read.jdbc(url, table, properties=_properties(properties))
    return df.select(*columns)
