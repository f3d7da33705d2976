"""Importance resampling: documents whose hashed word runs look like a target text are drawn more often."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from odsflow.llm.common import named, ranked, utf8, written

#: A-Z in lower case; every ASCII byte but letters and digits is a blank; bytes of other characters stay.
LOWERED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or c >= 97 and c <= 122 or c >= 128 else 32 for c in range(256))
#: Texts whose counts are sliced together.
TOGETHER = 32


# --- features of a text ------------------------------------------------------------------------

def words_of(body: bytes) -> list[bytes]:
    return body.translate(LOWERED).split()


def features(words: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """The bucket of each run of 1 to `longest` words, joined by one blank; repeats stay."""
    runs = list(words)
    for n in range(2, longest + 1):
        runs.extend(map(b" ".join, zip(*(words[i:] for i in range(n)))))
    return np.fromiter(map(crc32, runs), np.int64, len(runs)) % buckets


def count_buckets(longest: int, buckets: int) -> Callable:
    """A function that sums the buckets of all texts of a task: at most `buckets` rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for body in batch.column("body"):
                total += np.bincount(features(words_of(body.as_py()), longest, buckets), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    return counted


def bucket_totals(docs: DataFrame, text_col: str, longest: int, buckets: int) -> DataFrame:
    """(bucket, n) over all texts; a bucket without features has no row."""
    found = docs.select(utf8(named(text_col)).alias("body")).mapInArrow(count_buckets(longest, buckets), "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of every bucket: floor(1000 * the logarithm of target share over source share, each with one more a bucket)."""
    s, t = F.coalesce("s", F.lit(0)).cast("double"), F.coalesce("t", F.lit(0)).cast("double")
    sums = source.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_s")).crossJoin(target.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_t")))
    every = source.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    counts = every.join(source.select("bucket", F.col("n").alias("s")), "bucket", "left").join(
        target.select("bucket", F.col("n").alias("t")), "bucket", "left"
    ).crossJoin(F.broadcast(sums))  # one row
    ratio = (t + 1) * (F.col("all_s") + buckets) / ((s + 1) * (F.col("all_t") + buckets))
    return counts.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


# --- bit planes --------------------------------------------------------------------------------

def planes_of(values: np.ndarray, n: int) -> np.ndarray:
    """The lowest `n` bits of each value as planes: (n, rows, 64-bit words); bit k of a plane belongs to value k of its row."""
    width = -(-values.shape[1] // 64) * 8
    planes = np.zeros((n, len(values), width), np.uint8)
    for i in range(n):
        packed = np.packbits((values >> i & 1).astype(np.uint8), axis=1, bitorder="little")
        planes[i, :, :packed.shape[1]] = packed
    return planes.view(np.uint64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two's complement planes of signed gains, and what a bit of each plane is worth (the last one is negative)."""
    n = max(int(max(gain.max(), -gain.min() - 1)).bit_length(), 0) + 1
    worth = np.int64(1) << np.arange(n, dtype=np.int64)
    worth[-1] = -worth[-1]
    return planes_of(gain[None, :], n)[:, 0], worth


def sliced_sums(counts: np.ndarray, planes: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """Per row the exact sum of count times gain: AND of count and gain planes, popcounts, sums of powers of two."""
    sums = np.zeros(len(counts), np.int64)
    for i, plane in enumerate(planes_of(counts, int(counts.max(initial=0)).bit_length())):
        ones = np.bitwise_count(plane[:, None, :] & planes[None, :, :]).sum(axis=2, dtype=np.int64)
        sums += (ones @ worth) << i
    return sums


def weigh(longest: int, gain_array: np.ndarray) -> Callable:
    """A function that adds n_words, n_features and weight (the floored mean gain; 0 without features) to its rows."""
    planes, worth = gain_planes(gain_array)
    buckets = len(gain_array)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, sizes, weights = [], [], []
            bodies = batch.column("body")
            for first in range(0, len(bodies), TOGETHER):
                split = [words_of(b.as_py()) for b in bodies[first:first + TOGETHER]]
                found = [features(words, longest, buckets) for words in split]
                counts = np.stack([np.bincount(f, minlength=buckets) for f in found]).astype(np.int32)
                size = np.array([len(f) for f in found], np.int64)
                n_words.extend(map(len, split))
                sizes.append(size)
                weights.append(np.where(size > 0, sliced_sums(counts, planes, worth) // np.maximum(size, 1), 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), *[pa.array(np.concatenate(x or [np.zeros(0, np.int64)])) for x in (sizes, weights)]],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return weighed


# --- the draw ----------------------------------------------------------------------------------

def gumbel(seed: int, doc_id: Column) -> Column:
    """A standard Gumbel number in thousandths, floored, from the first 32 bits of a seeded SHA-256 of the id (NULL: no digits)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    longest: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: int = 2024,
) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_features, weight, score, rank (NULL if it is not drawn).

    Words are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case; features are all runs of 1
    to `longest` words, hashed to `buckets`. A bucket's gain compares its share in `target` with that in `docs`; a
    document's weight is the floored mean gain of its features, its score adds Gumbel noise, so the highest `percent` percent of scores
    among the documents of at least `least_words` words are a draw without repeats, with odds that follow the weights. Ties go to the
    smaller id, then NULL ids. All counts are over whole tables; the driver and the tasks hold one gain a bucket, whatever the input.
    NULL texts have no words; an empty target leaves every share to chance, empty `docs` give no rows; repeated rows are
    drawn each on its own; other columns are ignored.
    """
    source = written(bucket_totals(docs, text_col, longest, buckets), "source-buckets")
    wanted = written(bucket_totals(target, target_text_col, longest, buckets), "target-buckets")
    gain = np.zeros(buckets, np.int64)
    for row in gains(source, wanted, buckets).collect():  # one row a bucket
        gain[row["bucket"]] = row["gain"]
    own = docs.select(named(id_col).cast("long").alias("doc_id"), utf8(named(text_col)).alias("body"))
    schema = "doc_id long, n_words long, n_features long, weight long"
    scored = own.mapInArrow(weigh(longest, gain), schema).withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id")))
    scored = written(scored, "scored")
    long_enough = F.col("n_words") >= least_words
    order = [-F.col("score"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("n_features"), F.col("weight")]
    placed = ranked(scored.where(long_enough), order)
    drawn = F.when(F.col("rank") < F.expr(f"size * {int(percent)} div 100"), F.col("rank") + 1)
    columns = ("doc_id", "n_words", "n_features", "weight", "score")
    return placed.select(*columns, drawn.alias("rank")).unionByName(scored.where(~long_enough).select(*columns, F.lit(None).cast("long").alias("rank")))
