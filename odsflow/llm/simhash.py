"""Near-duplicates by SimHash, compared on bit planes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from odsflow.llm.common import group_starts, named, same_row, signed, text_key, utf8, whole_groups, with_key, written
from odsflow.llm.components import components

BITS, LANES = 64, 64
SEED = 42
HASHES_AT_ONCE = 1 << 15
#: Fingerprints of one slot compared in one task; larger slots are cut into pairs of parts of this size.
SLOT_PART = 4096
#: Slots up to this size are compared together, lane by lane.
SMALL_SLOT = 64
#: Lanes (pairs of fingerprints) compared at once: bounds the memory of one step.
LANES_AT_ONCE = 1 << 18
PLANES_PER_STEP = 8


# --- fingerprints ----------------------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 for a text without words."""
    words = text.lower().split()  # bytes: A-Z only, and white space is exactly \x20 and \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.append(np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 0x20), len(line))
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - shingle + 1)
    firsts, lasts = starts[:n].tolist(), (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]).tolist()
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        hashes = np.array(
            [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(firsts[at:at + HASHES_AT_ONCE], lasts[at:at + HASHES_AT_ONCE])],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_udf(shingle: int):
    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        values = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
        return pa.array(signed(values))

    return fingerprints


# --- bit planes ------------------------------------------------------------------------------

def bit_planes(values: np.ndarray) -> np.ndarray:
    """Row p holds bit p of all values, 64 values to a word."""
    padded = np.zeros(-(-len(values) // LANES) * LANES, dtype="<u8")
    padded[:len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def near_words(difference: Callable[[int, np.ndarray], np.ndarray], words: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lanes differ in at most `radius` planes: the words with such lanes, and their lane masks.

    `difference(p, at)` gives the differing lanes of plane p for the words `at`. A carry-save
    counter of a few words counts all lanes at once; it starts so high that it runs over just
    beyond the radius. Words whose lanes have all run over are abandoned.
    """
    depth = max(1, radius.bit_length())
    start = (1 << depth) - 1 - radius
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    at = np.arange(words)
    counter = [np.full(words, every if start >> d & 1 else 0, dtype=np.uint64) for d in range(depth)]
    over = np.zeros(words, dtype=np.uint64)
    for p in range(BITS):
        carry = difference(p, at)
        for d in range(depth):
            counter[d], carry = counter[d] ^ carry, counter[d] & carry
        over |= carry
        if p % PLANES_PER_STEP == PLANES_PER_STEP - 1:
            live = np.flatnonzero(over != every)
            if len(live) < len(at):
                at, over, counter = at[live], over[live], [c[live] for c in counter]
                if not len(at):
                    break
    return at, ~over


def lanes_of(at: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Lane numbers of the set bits of the given words."""
    if not len(at):
        return np.zeros(0, dtype=np.int64)
    bits = np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, lane = np.nonzero(bits)
    return at[word] * LANES + lane


class Roots:
    """Smallest reachable index of each index, kept flat."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.of[a], self.of[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.of[self.of]
                if (up == self.of).all():
                    break
                self.of = up


def _join_small(prints: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int, roots: Roots) -> None:
    """Slots of few fingerprints, all at once: lane i holds the pair of row i and the row `step` further on."""
    rows = np.concatenate([np.arange(s, s + n) for s, n in zip(starts.tolist(), sizes.tolist())])
    left = np.repeat(starts + sizes, sizes) - rows
    for step in range(1, int(sizes.max())):
        rows, left = rows[left > step], left[left > step]
        for at in range(0, len(rows), LANES_AT_ONCE):
            first = rows[at:at + LANES_AT_ONCE]
            a, b = bit_planes(prints[first]), bit_planes(prints[first + step])
            near = lanes_of(*near_words(lambda p, w: a[p, w] ^ b[p, w], a.shape[1], radius))
            near = first[near[near < len(first)]]
            roots.join(near, near + step)


def _join_large(prints: np.ndarray, start: int, size: int, radius: int, roots: Roots) -> None:
    """One slot of many fingerprints: its planes are stored once, blocks of queries run over them."""
    own = prints[start:start + size]
    planes = bit_planes(own)
    width = planes.shape[1]
    block = max(1, LANES_AT_ONCE // (width * LANES))
    for at in range(0, size, block):
        queries = own[at:at + block]
        flips = np.where(queries[:, None] >> np.arange(BITS, dtype=np.uint64) & np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
        near = lanes_of(*near_words(lambda p, w: planes[p, w % width] ^ flips[w // width, p], len(queries) * width, radius))
        query, other = near // (width * LANES) + at, near % (width * LANES)
        later = (other > query) & (other < size)
        roots.join(query[later] + start, other[later] + start)


def slot_links(radius: int):
    """For mapInArrow over rows sorted by slot and part: links of each fingerprint to the smallest near one of its slot."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, ("slot", "low", "high")):
            keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("slot", "low", "high")]
            prints = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            starts = group_starts(*keys)
            sizes = np.diff(np.append(starts, len(prints)))
            roots = Roots(len(prints))
            small = (sizes > 1) & (sizes <= SMALL_SLOT)
            if small.any():
                _join_small(prints, starts[small], sizes[small], radius, roots)
            for s, n in zip(starts[sizes > SMALL_SLOT].tolist(), sizes[sizes > SMALL_SLOT].tolist()):
                _join_large(prints, s, n, radius, roots)
            linked = np.flatnonzero(roots.of != np.arange(len(prints)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(prints[linked])), pa.array(signed(prints[roots.of[linked]]))], names=["node", "root"]
            )

    return links


# --- candidates ------------------------------------------------------------------------------

def _bits(value: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << width) - 1))


def _edges(bits: int, parts: int) -> list[tuple[int, int]]:
    cuts = [bits * i // parts for i in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def slots(value: Column, radius: int) -> Column:
    """The slots of a fingerprint: two within the radius share at least one.

    Cut into radius + 1 bands, two such fingerprints agree on a band; the rest, cut again into as
    many, agrees on a band too. A slot is the number of both bands and their values.
    """
    found = []
    for i, (low, high) in enumerate(_edges(BITS, radius + 1)):
        width = high - low
        below = F.lit(0).cast("long") if low == 0 else _bits(value, 0, low)
        rest = below if high == BITS else below.bitwiseOR(F.shiftleft(F.shiftrightunsigned(value, high), low))
        for j, (a, b) in enumerate(_edges(BITS - width, radius + 1)):
            number = i * (radius + 1) + j
            found.append(F.xxhash64(F.lit(number), _bits(value, low, width), _bits(rest, a, b - a)))
    return F.array(*found)


def near_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (node, root) that join all fingerprints within `radius` bits; `print` holds distinct longs.

    Slots with one fingerprint are dropped by a count that is reduced before its shuffle. A slot of
    more than SLOT_PART fingerprints is dealt out as pairs of parts, so no task holds a whole large
    slot and no pair is lost.
    """
    if radius < 1:
        return prints.select(F.col("print").alias("node"), F.col("print").alias("root")).limit(0)
    if radius > 15:
        raise ValueError("slots of a radius over 15 bits are too short to keep candidates few")
    placed = prints.select(F.explode(slots(F.col("print"), radius)).alias("slot"), "print")
    sizes = placed.groupBy("slot").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = written(sizes, "slot-sizes")  # read anew, so that Spark splits hot slots in the join
    parts = F.ceil(F.col("size") / F.lit(SLOT_PART)).cast("int")
    dealt = (
        placed.join(sizes, "slot")
        .select("slot", "print", parts.alias("parts"), F.pmod(F.xxhash64("print"), parts).cast("int").alias("part"))
        .select("slot", "print", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select("slot", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "print")
    )
    sorted_slots = dealt.repartition("slot", "low", "high").sortWithinPartitions("slot", "low", "high")
    return sorted_slots.mapInArrow(slot_links(radius), "node long, root long")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_key, print, group, component_id) of every row.

    `print` is the SimHash as a long, `group` the smallest fingerprint reachable over links of at
    most `radius` differing bits, `component_id` the smallest doc_id of the group. Equal
    fingerprints are one node, so a group of copies costs one node however large it is.
    A NULL text is the empty text; texts without words have fingerprint 0 and link like any other.
    A NULL doc_id takes part in the links but is never a component_id unless the group has no other.
    Repeated rows each get their row. Other columns are ignored; an empty table gives no rows.
    """
    own = docs.select(
        named(id_col).cast("long").alias("doc_id"),
        text_key(text_col),
        fingerprint_udf(shingle)(utf8(named(text_col))).alias("print"),
    )
    own = written(own, "prints")
    prints = written(own.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-prints")
    stars = components(near_links(prints, radius))
    grouped = prints.join(stars, prints["print"] == stars["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("group")
    )
    firsts = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
    members = written(grouped.join(firsts, "group").select("print", "group", "component_id"), "members")
    return own.join(members, "print").select("doc_id", "text_key", "print", "group", "component_id")


def hex_print(value: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of `docs`, one of each near-duplicate group: the smallest doc_id, then the smallest text key.

    NULL ids come last. Of rows that agree in id and text one stays. Columns and their order stay.
    """
    found = near_duplicates(docs, shingle, radius)
    order = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_key")
    best = found.groupBy("group").agg(F.min(order).alias("best")).select("best.doc_id", "best.text_key")
    keyed = with_key(docs)
    kept = keyed.join(best, same_row(keyed, best), "left_semi")
    return kept.groupBy("doc_id", "text_key").agg(F.first("row").alias("row")).select("row.*")
