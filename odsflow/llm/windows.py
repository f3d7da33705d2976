"""Windows that repeat across a corpus, found by content-chosen anchors.

A window is a run of units (words or bytes) of fixed length. Its anchor is the gram of fewer units
with the least hash in it, so equal windows have equal anchors at equal places. Neighbouring
windows with the same anchor form a cell; a text of n units has about 2 n / (window - gram) cells.
Equal cells are equal runs of windows and are settled as a whole, by counting; that takes care of
all but the ends of a repeated passage. Different cells with the same anchor are brought together as
pieces of text and compared window by window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from odsflow.llm.common import same_row, signed, whole_groups, written

#: Pieces of one anchor that one task compares; more are dealt out as pairs of parts of this size.
PIECES_PER_PART = 10_000
#: Bits of a position beside the hash in one number; longer texts are cut into segments of windows.
POSITION_BITS = 24
SEGMENT = 1 << 22
NO_ID = (1 << 63) - 1


# --- anchors of one text ---------------------------------------------------------------------

def gram_hashes(units: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all grams of `gram` units (a power of two), built by doubling from hashes of the units."""
    if len(units) < gram:
        return np.zeros(0, dtype=np.uint64)
    hashes, size = np.ascontiguousarray(units, dtype=np.uint64), 1
    while size < gram:
        left, right = hashes[:len(hashes) - size], hashes[size:]
        hashes = (left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 + 2 * size) + right * np.uint64(0xC2B2AE3D27D4EB4F)
        size *= 2
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` keys in a row, from running minima of blocks in both directions."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def cells(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor place, first window and number of windows of each cell; a window covers `width` grams."""
    windows = len(hashes) - width + 1
    if windows < 1:
        return (np.zeros(0, dtype=np.int64),) * 3
    low = np.uint64((1 << POSITION_BITS) - 1)
    places = np.empty(windows, dtype=np.int64)
    for at in range(0, windows, SEGMENT):
        part = hashes[at:at + SEGMENT + width - 1]
        keys = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        least = _sliding_least(keys, width)
        places[at:at + len(least)] = (least & low).astype(np.int64) + at
    new = np.ones(windows, dtype=bool)
    new[1:] = places[1:] != places[:-1]
    if windows > SEGMENT:
        new[::SEGMENT] = True
    firsts = np.flatnonzero(new)
    return places[firsts], firsts, np.diff(np.append(firsts, windows))


# --- texts as units --------------------------------------------------------------------------

class WordUnits:
    """A text as its words; a run of units is the words joined by one space."""

    def __init__(self, text: bytes):
        words = text.split()  # bytes: white space is exactly \x20 and \x09-\x0D
        self.n = len(words)
        self.line = b" ".join(words)
        self.hashes = np.array([xxhash.xxh64_intdigest(w, 7) for w in words], dtype=np.uint64)
        breaks = np.flatnonzero(np.frombuffer(self.line, dtype=np.uint8) == 0x20)
        self.starts = np.append(0, breaks + 1)
        self.ends = np.append(breaks, len(self.line))

    def bounds(self, firsts: np.ndarray, sizes: np.ndarray) -> tuple[list[int], list[int]]:
        return self.starts[firsts].tolist(), self.ends[firsts + sizes - 1].tolist()


BYTE_HASHES = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) for b in range(256)], dtype=np.uint64)


class ByteUnits:
    """A text as its bytes."""

    def __init__(self, text: bytes):
        self.n, self.line = len(text), text
        self.hashes = BYTE_HASHES[np.frombuffer(text, dtype=np.uint8)]

    def bounds(self, firsts: np.ndarray, sizes: np.ndarray) -> tuple[list[int], list[int]]:
        return firsts.tolist(), (firsts + sizes).tolist()


def text_cells(units, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, digest, first window and number of windows of each cell of a text."""
    hashes = gram_hashes(units.hashes, gram)
    places, firsts, counts = cells(hashes, window - gram + 1)
    if not len(places):
        return (np.zeros(0, dtype=np.int64),) * 4
    starts, ends = units.bounds(firsts, counts + (window - 1))
    digest, line = xxhash.xxh3_64_intdigest, units.line
    offsets = (places - firsts).tolist()
    digests = np.array([digest(line[a:b], o & 0xFFFFFFFF) for a, b, o in zip(starts, ends, offsets)], dtype=np.uint64)
    return signed(hashes[places]), signed(digests), firsts, counts


CELL = "doc_id long, text_key long, anchor long, digest long, first int, n int"
ROWS_AT_ONCE = 1 << 16


def cell_rows(units: type, window: int, gram: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for i in range(batch.num_rows):
                found = text_cells(units(batch.column("body")[i].as_py()), window, gram)
                if len(found[0]):
                    held.append((i, found))
                    size += len(found[0])
                if size >= ROWS_AT_ONCE or (held and i == batch.num_rows - 1):
                    owner = np.repeat([h[0] for h in held], [len(h[1][0]) for h in held])
                    columns = [np.concatenate([h[1][k] for h in held]) for k in range(4)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(owner)), batch.column("text_key").take(pa.array(owner)),
                         pa.array(columns[0]), pa.array(columns[1]),
                         pa.array(columns[2].astype(np.int32)), pa.array(columns[3].astype(np.int32))],
                        names=["doc_id", "text_key", "anchor", "digest", "first", "n"],
                    )
                    held, size = [], 0

    return rows


PIECE = "anchor long, digest long, rank long, kinds long, piece binary"


def piece_rows(units: type, window: int) -> Callable:
    """The text of each wanted cell of each document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("rank", pa.int64()), ("kinds", pa.int64()), ("piece", pa.binary())])
        for batch in batches:
            for body, wanted in zip(batch.column("body"), batch.column("wanted")):
                text, wanted = units(body.as_py()), wanted.as_py()
                firsts = np.array([w["first"] for w in wanted])
                sizes = np.array([w["n"] for w in wanted]) + (window - 1)
                pieces = [text.line[a:b] for a, b in zip(*text.bounds(firsts, sizes))]
                columns = [[w[k] for w in wanted] for k in ("anchor", "digest", "rank", "kinds")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip([*columns, pieces], schema)], schema=schema
                )

    return rows


# --- the corpus ------------------------------------------------------------------------------

def rank_of(doc_id: Column) -> Column:
    """The order of ids; a NULL id comes after all others."""
    return F.coalesce(doc_id, F.lit(NO_ID))


def repeated_spans(texts: DataFrame, units: type, window: int, gram: int, compare: Callable, earlier_only: bool) -> DataFrame:
    """(doc_id, text_key, spans): runs (start, n) of repeated windows of each text that has any.

    `texts` is `text_rows`. With `earlier_only` a window counts as repeated if a text of smaller id
    has it too, else if it stands anywhere else. `compare` is for mapInArrow over PIECE rows with
    `part` and `other`, sorted by anchor, part, other and rank; it returns (anchor, digest, at, n),
    the repeated windows of a cell relative to its first.

    Shuffled are the cells (not the windows), and the texts once. Counts are reduced before their
    shuffle; joins of cells with what is known of their anchor are plain equality joins, whose hot
    keys Spark splits.
    """
    found = texts.mapInArrow(cell_rows(units, window, gram), CELL)
    cells_of = written(found.withColumn("rank", rank_of(F.col("doc_id"))), "cells")
    several = F.min("rank") < F.max("rank") if earlier_only else F.count(F.lit(1)) > 1
    shared_anchors = cells_of.groupBy("anchor").agg(several.alias("several")).where("several").select("anchor")
    shared_anchors = written(shared_anchors, "shared-anchors")  # read anew, so that Spark splits hot anchors in the join
    shared = written(cells_of.join(shared_anchors, "anchor"), "shared-cells")
    kinds = written(shared.groupBy("anchor", "digest").agg(
        F.min("rank").alias("least"), F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("rank", "doc_id", "text_key", "first", "n")).alias("one"),
    ), "kinds")
    per_anchor = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    wanted = kinds.join(per_anchor, "anchor").select(
        F.col("one.doc_id").alias("doc_id"), F.col("one.text_key").alias("text_key"),
        F.struct("anchor", "digest", F.col("least").alias("rank"), "kinds", F.col("one.first").alias("first"), F.col("one.n").alias("n")).alias("cell"),
    ).groupBy("doc_id", "text_key").agg(F.collect_list("cell").alias("wanted"))
    with_cells = texts.join(wanted, same_row(texts, wanted)).select(texts["body"], "wanted")
    pieces = with_cells.mapInArrow(piece_rows(units, window), PIECE)
    parts = F.ceil(F.col("kinds") / F.lit(PIECES_PER_PART)).cast("int")
    dealt = (
        pieces.select("*", parts.alias("parts"), F.pmod(F.xxhash64("digest"), parts).cast("int").alias("own"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("partner"))
        .select("anchor", "digest", "rank", "piece", F.least("own", "partner").alias("part"), F.greatest("own", "partner").alias("other"))
        .repartition("anchor", "part", "other").sortWithinPartitions("anchor", "part", "other", "rank", "digest")
    )
    judged = written(dealt.mapInArrow(compare, "anchor long, digest long, at int, n int").distinct(), "judged")
    known = shared.join(kinds.select("anchor", "digest", "least", "copies"), ["anchor", "digest"])
    whole = F.col("rank") > F.col("least") if earlier_only else F.col("copies") > 1
    known = written(known.select("anchor", "digest", "doc_id", "text_key", "first", "n", whole.alias("whole")), "known")
    at_ends = known.where("NOT whole").drop("n").join(judged, ["anchor", "digest"]).select(
        "doc_id", "text_key", (F.col("first") + F.col("at")).alias("start"), "n"
    )
    spans = known.where("whole").select("doc_id", "text_key", F.col("first").alias("start"), "n").unionByName(at_ends)
    return spans.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def covered_units(spans: list[dict] | None, n: int, window: int) -> np.ndarray:
    """Which of a text's n units lie in a repeated window."""
    change = np.zeros(n + 1, dtype=np.int64)
    if spans:
        starts = np.array([s["start"] for s in spans])
        ends = starts + np.array([s["n"] for s in spans]) + (window - 1)
        np.add.at(change, starts, 1)
        np.add.at(change, ends, -1)
    return np.cumsum(change[:n]) > 0


def piece_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return whole_groups(batches, ("anchor", "part", "other"))
