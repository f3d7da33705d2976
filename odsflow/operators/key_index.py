"""A stored index of the keys that earlier loads brought, so that a load is checked against them without reading the target.

Layout under `root`:

    _shape/                     one row: buckets and blocks, fixed when the index is made
    keys/load=<id>/bucket=<n>/  the key columns and their 64-bit fingerprint of each accepted row
    blooms/load=<id>/           (block, bits): Bloom filter blocks of 32,768 bits

A fingerprint gives a key its bucket, its filter block and its bits in that block. A probe first asks the filter, which is about a byte
per key; only keys it cannot rule out are compared with the stored keys, and only in their buckets. The answer is exact: the filter
never misses a key, and what it lets through by mistake is compared by value. Every load has folders of its own, written whole, so a
load that is repeated replaces its keys and does not find itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from odsflow.operators.quality import REASONS, KeySpec
from odsflow.session import child_names, delete_folder, path_exists, scratch_path

#: Bits in a filter block (that of Spark's bitmap functions), bits set per key, bits of the filter per key.
BLOCK_BITS, PROBES, BITS_PER_KEY = 32_768, 7, 10
KEYS_PER_BUCKET = 5_000_000
LEAST_BUCKETS, MOST_BUCKETS = 16, 20_000
SHAPE = "buckets int, blocks long, columns string"
PRINT, BUCKET, BLOCK = "_print", "_bucket", "_block"


@dataclass(frozen=True)
class KeyIndex:
    """An index that is there: its folder, the key it is for, and its shape."""

    root: str
    spec: KeySpec
    buckets: int
    blocks: int


def open_index(spark: SparkSession, root: str, spec: KeySpec, expected_keys: int = 1_000_000) -> KeyIndex:
    """The index under `root`; a new one is shaped for `expected_keys`.

    More keys than expected stay right, but fill the filter, so that more stored keys are read (see `index_report`, `rebuild`).
    """
    folder, columns = f"{root}/_shape", ",".join(spec.columns)
    if not path_exists(spark, f"{folder}/_SUCCESS"):
        buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-expected_keys // KEYS_PER_BUCKET)))
        blocks = max(1, -(-expected_keys * BITS_PER_KEY // BLOCK_BITS))
        spark.createDataFrame([(buckets, blocks, columns)], SHAPE).coalesce(1).write.mode("overwrite").parquet(folder)
    shape = spark.read.schema(SHAPE).parquet(folder).first()
    if shape["columns"] != columns:
        raise ValueError(f"{root} is an index of {shape['columns']}, not of {columns}")
    return KeyIndex(root, spec, shape["buckets"], shape["blocks"])


def _columns(spec: KeySpec) -> list[Column]:
    return [F.col(f"`{c}`") for c in spec.columns]


def _whole(spec: KeySpec) -> Column:
    """Keys with a NULL part are no keys: a primary key may not have one, and in a unique index they never collide."""
    return reduce(and_, [c.isNotNull() for c in _columns(spec)])


def _placed(index: KeyIndex, df: DataFrame) -> DataFrame:
    """The key columns with fingerprint and bucket."""
    printed = df.filter(_whole(index.spec)).select(*_columns(index.spec), F.xxhash64(*_columns(index.spec)).alias(PRINT))
    return printed.withColumn(BUCKET, F.pmod(PRINT, F.lit(index.buckets)).cast("int"))


def _bits(index: KeyIndex) -> list[Column]:
    """The block of a fingerprint, and the positions of its bits there (double hashing)."""
    mixed = F.xxhash64(F.lit(1), PRINT)
    first, step = F.pmod(mixed, F.lit(BLOCK_BITS)), F.pmod(F.shiftright(mixed, 20), F.lit(BLOCK_BITS // 2)) * 2 + 1
    positions = [F.pmod(first + step * i, F.lit(BLOCK_BITS)) for i in range(PROBES)]
    return [F.pmod(F.xxhash64(F.lit(2), PRINT), F.lit(index.blocks)).alias(BLOCK), F.array(*positions).alias("positions")]


def load_name(load: str) -> str:
    """A load's folder; any text names one."""
    return f"load={quote(load, safe='')}"


def _loads(spark: SparkSession, index: KeyIndex, part: str, but: str | None) -> list[str]:
    """Folders of the finished loads, without that of `but`. A load counts once its filter is written, which is its last step."""
    skipped = load_name(but) if but is not None else None
    names = [n for n in child_names(spark, f"{index.root}/blooms") if n.startswith("load=") and n != skipped]
    return [f"{index.root}/{part}/{n}" for n in names if path_exists(spark, f"{index.root}/blooms/{n}/_SUCCESS")]


def add_keys(index: KeyIndex, rows: DataFrame, load: str) -> None:
    """Stores the keys of the rows that a load has brought; done again, it replaces what the same load stored before.

    The filter block is built by Spark's bitmap aggregates, which combine before the shuffle.
    """
    spark, name = rows.sparkSession, load_name(load)
    delete_folder(spark, f"{index.root}/blooms/{name}")
    keys = f"{index.root}/keys/{name}"
    placed = _placed(index, rows)
    placed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(keys)
    stored = _stored(spark, [keys], placed.schema)
    bits = stored.select(*_bits(index)).select(BLOCK, F.explode("positions").alias("position"))
    # Spark numbers bits from 1 within a bucket of BLOCK_BITS
    blocks = bits.groupBy(BLOCK).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("position") + 1)).alias("bits"))
    blocks.write.mode("overwrite").parquet(f"{index.root}/blooms/{name}")


def _stored(spark: SparkSession, folders: list[str], schema: StructType) -> DataFrame:
    """Stored keys of some loads; the bucket is a partition column of the files."""
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(f) for f in folders])


def _filter(spark: SparkSession, index: KeyIndex, but: str | None) -> DataFrame | None:
    """(block, bits) of all loads but one."""
    folders = _loads(spark, index, "blooms", but)
    if not folders:
        return None
    blooms = reduce(DataFrame.unionByName, [spark.read.schema(f"{BLOCK} long, bits binary").parquet(f) for f in folders])
    return blooms.groupBy(BLOCK).agg(F.bitmap_or_agg("bits").alias("bits"))


def _set(position: Column) -> Column:
    """Whether the bit is set in `bits`."""
    byte = F.conv(F.hex(F.substring("bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1


def candidates(index: KeyIndex, rows: DataFrame, load: str | None = None) -> DataFrame | None:
    """The different keys of the rows that the filter of all other loads cannot rule out; None without other loads."""
    found = _filter(rows.sparkSession, index, load)
    if found is None:
        return None
    placed = _placed(index, rows).distinct().select("*", *_bits(index))  # a repeated key asks once
    asked = placed.join(found, BLOCK)
    maybe = asked.filter(reduce(and_, [_set(F.col("positions")[i]) for i in range(PROBES)]))
    return maybe.select(*_columns(index.spec), PRINT, BUCKET)


def known_keys(index: KeyIndex, rows: DataFrame, load: str | None = None) -> DataFrame | None:
    """The keys of the rows that other loads brought, each once; None if there are none.

    The candidates are written to the scratch folder; the buckets they name (at most `index.buckets`) become a filter on the
    partition column, so that no other bucket is read.
    """
    spark = rows.sparkSession
    maybe = candidates(index, rows, load)
    if maybe is None:
        return None
    path = f"{scratch_path(spark, 'key-candidates')}/rows"
    maybe.write.parquet(path)
    maybe = spark.read.schema(maybe.schema).parquet(path)
    buckets = sorted(r[0] for r in maybe.select(BUCKET).distinct().collect())
    if not buckets:
        return None
    stored = _stored(spark, _loads(spark, index, "keys", load), maybe.schema).filter(F.col(BUCKET).isin(buckets))
    return maybe.join(stored, [BUCKET, PRINT, *index.spec.columns], "left_semi").select(*_columns(index.spec))


def with_known_keys(rows: DataFrame, indexes: Sequence[KeyIndex], load: str | None = None) -> DataFrame:
    """Adds `known:<name>` to the reasons of rows whose key an earlier load brought.

    `load` names the load the rows belong to, whose own stored keys do not count. Without a candidate the rows pass
    untouched and nothing is joined.
    """
    for index in indexes:
        known = known_keys(index, rows, load)
        if known is None:
            continue
        known = known.select(F.struct(*_columns(index.spec)).alias("_known"))
        same = reduce(and_, [c == F.col(f"_known.`{n}`") for c, n in zip(_columns(index.spec), index.spec.columns)])
        found = F.when(F.col("_known").isNotNull(), F.array(F.lit(f"known:{index.spec.name}"))).otherwise(F.array().cast("array<string>"))
        rows = rows.join(known, same, "left").withColumn(REASONS, F.concat(F.col(REASONS), found)).drop("_known")
    return rows


def index_report(spark: SparkSession, index: KeyIndex) -> DataFrame:
    """One row: loads, keys, and the share of the filter's bits that are set (above one half it rules out less than planned)."""
    loads = _loads(spark, index, "keys", None)
    found = _filter(spark, index, None)
    if found is None:
        return spark.createDataFrame([(0, 0, 0.0)], "loads int, keys long, filled double")
    keys = sum(spark.read.parquet(folder).count() for folder in loads)  # from file footers
    filled = F.sum(F.bitmap_count("bits")) / F.lit(float(BLOCK_BITS * index.blocks))
    return found.agg(F.lit(len(loads)).alias("loads"), F.lit(keys).cast("long").alias("keys"), filled.alias("filled"))


def rebuild(spark: SparkSession, index: KeyIndex, root: str, expected_keys: int, load: str = "folded") -> KeyIndex:
    """All loads folded into one of a new index under another folder, shaped for more keys."""
    fresh = open_index(spark, root, index.spec, expected_keys)
    folders = _loads(spark, index, "keys", None)
    if folders:
        add_keys(fresh, reduce(DataFrame.unionByName, [spark.read.parquet(f) for f in folders]).select(*_columns(index.spec)), load)
    return fresh
