"""Tables kept as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from odsflow.functions.text import unescape_line_breaks
from odsflow.session import is_directory


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A parquet table of a folder; a column list prunes the scan."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def stream_table(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a stream of its files; the schema is that of the table."""
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if is_directory(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def read_text_table(
    spark: SparkSession, path: str, schema: str | StructType, delimiter: str = ",", line_breaks: bool = False,
    escaped: bool = True,
) -> DataFrame:
    """Delimited text as written by `sinks.tables.overwrite_text`.

    Files of others may hold texts as they are (`escaped` False), and line feeds inside quoted
    fields (`line_breaks`); with the latter Spark cannot split a file.
    """
    rows = (
        spark.read.schema(schema)
        .options(sep=delimiter, escape='"', nullValue="\\N", multiLine=line_breaks, lineSep="\n")
        .csv(path)
    )
    texts = [f.name for f in rows.schema.fields if escaped and isinstance(f.dataType, StringType)]
    return rows.withColumns({name: unescape_line_breaks(F.col(f"`{name}`")) for name in texts}) if texts else rows
